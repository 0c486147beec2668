"""Hash tables of problem 3: pairs come from few buckets, and the chance to meet does not fall with the size of an event."""

import os

import numpy as np
import pandas as pd
import pytest

from podium.llm import matching

DATA = "/root/testdata/sf0.1"


def test_pairs_meet_as_often_with_more_bits():
    rng = np.random.default_rng(7)
    index = matching.Index(np.zeros((matching.BUCKETS, matching.WIDTH), dtype=np.float32), matching.planes_for(rng))
    a = matching.unit(rng.standard_normal((500, matching.WIDTH)))
    off = rng.standard_normal(a.shape)
    off = matching.unit(off - (off * a).sum(axis=1, keepdims=True) * a)
    for cosine, least in ((0.8, 0.87), (0.9, 0.99)):
        b = cosine * a + (1 - cosine**2) ** 0.5 * off
        shares = {}
        for bits in (13, 14, 16):
            tables = np.arange(matching.tables_for(bits))  # those of one view
            x, y = (index.codes([v.astype(np.float32)] * matching.VIEWS, bits, tables) for v in (a, b))
            shares[bits] = (x == y).any(axis=1).mean()
        assert min(shares.values()) > least, shares


def test_met_pairs_are_those_of_equal_codes():
    rng = np.random.default_rng(2)
    b, p = rng.integers(-1, 6, (40, 3)).astype(np.int32), rng.integers(-1, 6, (30, 3)).astype(np.int32)
    want = {(i, j) for i in range(30) for j in range(40) if ((b[j] == p[i]) & (b[j] >= 0)).any()}
    for most in (1, 50, 10_000):
        got = [pair for rows in matching.met(b, p, most) for pair in zip(*rows)]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.fixture(scope="module")
def sides():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    board = pd.read_parquet(f"{DATA}/rankings.parquet")
    board = board[board.scan_kind == "final"].sort_values("row_id").drop_duplicates(["event_id", "scan_id", "rank"])
    board = matching._ready(board.rename(columns={"row_id": "id"}))
    posted = matching._ready(pd.read_parquet(f"{DATA}/mirror_board.parquet").rename(columns={"mirror_id": "id"}))
    sample = pd.concat([d[d.id % 13 == 0] for d in (board, posted)])
    records = [(matching.name_ids(c), matching.group_ids(a), matching.place_ids(p), matching.amount_ids(n)) for c, a, p, n in zip(sample.commander, sample.alliance, sample.place, sample.points)]
    index = matching.Index(matching.train(records), matching.planes_for(np.random.default_rng(3)))
    index.centres = np.stack([v[v.any(axis=1)].mean(axis=0) for v in index.views(sample.commander, sample.alliance, sample.place, sample.points)])
    return index, board, posted


def test_few_pairs_meet_and_few_are_lost(sides):
    """Posted rows whose id is divisible by 50 against all board rows of their event, at the bits in use."""
    index, board, posted = sides
    every, found, pairs, all_pairs, largest = set(), set(), 0, 0, 0.0
    for event, asked in posted[posted.id % 50 == 0].groupby("event_id"):
        rows, asked = board[board.event_id == event].reset_index(drop=True), asked.reset_index(drop=True)
        views = [index.views(d.commander, d.alliance, d.place, d.points) for d in (rows, asked)]
        codes = [index.codes(v, matching.bits_for(len(rows))) for v in views]
        pairs += sum(len(x) for x, _ in matching.met(*codes))
        all_pairs += len(rows) * len(asked)
        largest = max(largest, max(np.bincount(c[c >= 0]).max() / len(rows) for c in codes[0].T))
        every |= {x[:2] for x in matching.candidates(index, rows, asked, exhaustive=True) if x[2] > 0}
        found |= {x[:2] for x in matching.candidates(index, rows, asked) if x[2] > 0}
    print(f"{len(every)} pairs, recall {len(found & every) / len(every):.4f}, {pairs / all_pairs:.4f} of all pairs meet, the largest bucket holds {largest:.4f} of an event")
    assert len(every) > 100 and len(found & every) >= 0.95 * len(every)
    assert pairs <= 0.05 * all_pairs and largest <= 0.05


def test_one_block_of_many_events_is_hashed_as_well(sides):
    """16 events as one context of some 18,000 records: more bits, no more pairs, the same recall."""
    index, board, posted = sides
    events = sorted(board.event_id.unique())[:16]
    rows, asked = (d[d.event_id.isin(events)].reset_index(drop=True) for d in (board, posted[posted.id % 50 == 0]))
    bits = matching.bits_for(len(rows))
    codes = [index.codes(index.views(d.commander, d.alliance, d.place, d.points), bits) for d in (rows, asked)]
    pairs = sum(len(x) for x, _ in matching.met(*codes))
    every = {x[:2] for x in matching.candidates(index, rows, asked, exhaustive=True) if x[2] > 0}
    found = {x[:2] for x in matching.candidates(index, rows, asked) if x[2] > 0}
    print(f"{len(rows)} x {len(asked)} records, {bits} bits, {len(every)} pairs, recall {len(found & every) / len(every):.4f}, {pairs / (len(rows) * len(asked)):.4f} of all pairs meet")
    assert bits > matching.TABLES_BITS and len(found & every) >= 0.95 * len(every) and pairs <= 0.05 * len(rows) * len(asked)
