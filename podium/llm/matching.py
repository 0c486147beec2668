"""Problem 3: matching records of two tables that share no key.

Records, their attributes and the tokens of these form a graph.  Random walks
over it give token sequences on which skip-gram vectors with negative sampling
are trained; a record's vector is the weighted sum of its tokens' vectors.
The vectors share one strong direction, so each view - the whole record, its
name, the rest, its amount - is centred before it is hashed; records of one
context (here an event) are blocked by multi-table random hyperplane hashing
in each view, and pairs come from shared buckets alone.  They are reranked
exactly: name, group, place and amount are compared as values, best bound
first, until no candidate left can come near the best.

All weights are fitted.  Two logistic models, one of the name (how the names
compare, and the cosine of the name view) and one of the rest (amount, place,
group, and the cosine of the rest), are each fitted on pairs that the other's
evidence makes certain against random pairs, so cosines and comparisons are
calibrated together; the starting weights only act as a prior worth a few
pairs, whatever the number of pairs.  The sum of both and the chance of a
random pair is the log-odds from which the confidence follows.

The vectors are the index and are fitted on walks from a bounded number of
records (WALK_RECORDS), the models on the partners of a bounded number of
posted rows (CALIBRATE_ROWS), both taken by hashed id; every row of both tables
is indexed and searched.  They live in tables of fixed size, the only thing
sent to the workers.  One path serves contexts of all sizes: a record goes to a
cell for every prefix of its codes that the size of its context asks for; a
context of up to CELL_ROWS asks for none, so its records go to one cell that
holds all tables.  In a cell only full codes are compared, so the pairs that
meet are the same however a context is divided.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.canonical import edits, seen
from podium.llm.normalize import plain
from podium.llm.variants import NICKNAMES, group_tokens, letters, name_likeness, person_tokens, same_company
from podium.session import durable

#: Hashed vocabulary and length of the vectors.
BUCKETS, WIDTH = 1 << 15, 48
#: Records from which walks start, walks of each, tokens of a walk, window and negative samples.
WALK_RECORDS, WALKS, STEPS, REACH, NEGATIVE = 6_000, 3, 6, 2, 4
#: Posted rows whose certain partners the models are fitted on, and the least amount that can make a partner certain.
CALIBRATE_ROWS, CERTAIN_POINTS = 4_000, 10_000
#: Hash tables of each view at the least bits of a table; see ``tables_for``.
TABLES, TABLES_BITS = 48, 13
#: Most bits of a table, and the cosine whose chance to share a bucket does not fall with the bits; it is a little below those
#: that matter, as the bits of a table, of planes at right angles, are not independent.
MOST_BITS, NEAR_COSINE = 16, 0.76
#: Records of a context, on the larger side, that one cell takes.
CELL_ROWS = 50_000
#: Contexts up to which their sizes are sent to every worker.
MAX_CONTEXTS = 100_000
#: Least posterior of a match, and how far below the best a candidate is still weighed.
ACCEPT, MARGIN = 0.5, 7.0
#: Share of letter triples below which two names can't be alike.
SHARED = 0.25
# How names, amounts, places and groups may compare, with the log-odds that the fit starts from.
NAME = {"same": 8.5, "near": 7.5, "hint": 4.5, "far": 2.5, "none": 0.0, "other": -3.0}
AMOUNT = {"same": 7.0, "round": 5.0, "near": 3.5, "none": 0.0, "other": -5.0}
PLACE = {"same": 0.7, "none": 0.0, "other": -5.0}
GROUP = {1: 2.5, 0: 0.0, -1: -1.5}
#: How strongly the fit is drawn to where it starts from, in squares of log-odds.
PRIOR = 0.5
VIEWS = 4
MISSING = frozenset(["", "?", "-", "??", "???", "n/a", "none", "unknown"])


def place_of(text: str | None) -> str | None:
    """The digits of a place however it is written; None if there are none."""
    digits = "".join(c for c in text or "" if c.isdigit())
    return digits or None


def _hash(token: str) -> int:
    return xxhash.xxh32_intdigest(token) & (BUCKETS - 1)


def _grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)] or [padded]


@lru_cache(maxsize=200_000)
def name_parts(text: str | None) -> tuple[str, tuple[str, ...]]:
    """(code of a default name, tokens) of a name; both empty if there is none."""
    if text is None or text.strip().casefold() in MISSING:
        return "", ()
    code, tokens = person_tokens(text)
    return code, tuple(tokens)


@lru_cache(maxsize=200_000)
def name_ids(text: str | None) -> tuple[int, ...]:
    code, tokens = name_parts(text)
    if code:
        return tuple({_hash(f"n:{g}") for g in _grams("".join(code).casefold())} | {_hash(f"c:{code}")})
    out = set()
    for t in tokens:
        full = NICKNAMES.get(t, t)
        out.add(_hash(f"w:{full}"))
        out.update(_hash(f"n:{g}") for g in _grams(seen(full)))
    return tuple(out)


@lru_cache(maxsize=100_000)
def group_ids(text: str | None) -> tuple[int, ...]:
    if not text:
        return ()
    tag, words = group_tokens(text)
    out = {_hash(f"g:{letters(w)}") for w in words} | ({_hash(f"t:{seen(tag.casefold())}")} if tag else set())
    return tuple(out)


def amount_ids(points: float | None) -> tuple[int, ...]:
    if points is None or points != points or points <= 0:
        return ()
    return tuple(int(x) for x in amount_rows(np.array([points], dtype=float))[0])


def amount_rows(points: np.ndarray) -> np.ndarray:
    """The three token ids of each positive amount: its thousands, and two overlapping steps of 5 %."""
    step = np.log(points) / math.log(1.05)
    marks = np.stack([np.round(points / 1000) * 4, np.floor(step) * 4 + 1, np.floor(step + 0.5) * 4 + 2], axis=1).astype(np.uint64)
    marks = (marks + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((marks ^ (marks >> np.uint64(29))) >> np.uint64(17)) & np.uint64(BUCKETS - 1)


def place_ids(place: str | None) -> tuple[int, ...]:
    return (_hash(f"s:{place}"),) if place else ()


def train(records: list[tuple[tuple[int, ...], ...]], seed: int = 5) -> np.ndarray:
    """Skip-gram vectors of the hashed tokens from random walks over ``records``, each a tuple of attributes' token ids."""
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((BUCKETS, WIDTH)).astype(np.float32) / math.sqrt(WIDTH)
    edges = [(n, t) for n, attributes in enumerate(records) for tokens in attributes for t in tokens]
    if not edges:
        return vectors
    pairs = np.array(edges, dtype=np.int64)
    of_record = pairs[np.argsort(pairs[:, 0], kind="stable")]
    start = np.searchsorted(of_record[:, 0], np.arange(len(records) + 1))
    of_token = pairs[np.argsort(pairs[:, 1], kind="stable")]
    first = np.searchsorted(of_token[:, 1], np.arange(BUCKETS + 1))
    at = np.repeat(np.flatnonzero(np.diff(start)), WALKS)
    walk = np.empty((len(at), STEPS), dtype=np.int64)
    for s in range(STEPS):  # record -> (attribute's) token -> record with that token -> ...
        walk[:, s] = of_record[start[at] + (rng.random(len(at)) * (start[at + 1] - start[at])).astype(np.int64), 1]
        token = walk[:, s]
        at = of_token[first[token] + (rng.random(len(at)) * (first[token + 1] - first[token])).astype(np.int64), 0]
    centre = np.concatenate([walk[:, d:].ravel() for d in range(1, REACH + 1)])
    context = np.concatenate([walk[:, :-d].ravel() for d in range(1, REACH + 1)])
    order = rng.permutation(len(centre))
    noise = np.bincount(walk.ravel(), minlength=BUCKETS) ** 0.75
    noise = np.cumsum(noise / noise.sum())
    other = np.zeros((BUCKETS, WIDTH), dtype=np.float32)
    rate, size = 0.05, 4096
    for begin in range(0, len(order), size):
        part = order[begin : begin + size]
        c = centre[part]
        targets = np.concatenate([context[part][:, None], np.searchsorted(noise, rng.random((len(part), NEGATIVE)))], axis=1)
        label = np.zeros(targets.shape, dtype=np.float32)
        label[:, 0] = 1
        v, u = vectors[c], other[targets]
        g = rate * (label - 1 / (1 + np.exp(-np.einsum("nd,nkd->nk", v, u))))
        _add(vectors, c, np.einsum("nk,nkd->nd", g, u))
        _add(other, targets.ravel(), (g[:, :, None] * v[:, None, :]).reshape(-1, WIDTH))
    return vectors


def _add(matrix: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds ``values`` to ``rows`` of ``matrix``; rows may repeat."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    begin = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    matrix[rows[begin]] += np.add.reduceat(values[order], begin, axis=0)


@dataclass
class Index:
    """Token vectors, the centres of the views, hyperplanes and the fitted weights of name and rest."""

    vectors: np.ndarray
    planes: np.ndarray
    centres: np.ndarray | None = None
    name: np.ndarray = field(default_factory=lambda: np.array([*NAME.values(), 0.0]))
    rest: np.ndarray = field(default_factory=lambda: np.array([*AMOUNT.values(), *PLACE.values(), *GROUP.values(), 0.0]))

    def __post_init__(self) -> None:
        self.kept: dict[tuple, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "kept": {}}

    def part(self, ids: tuple[int, ...]) -> np.ndarray:
        known = self.kept.get(ids)
        if known is None:
            if len(self.kept) > 150_000:
                self.kept.clear()
            v = self.vectors[list(ids)].sum(axis=0) if ids else np.zeros(WIDTH, dtype=np.float32)
            known = self.kept[ids] = v / (math.sqrt(float(v @ v)) or 1.0)
        return known

    def views(self, names, groups, places, amounts) -> list[np.ndarray]:
        """The whole record, its name, the rest and the amount, as centred unit vectors; zero where nothing is known."""
        many = lambda function, values: np.array([self.part(function(x)) for x in values], dtype=np.float32).reshape(-1, WIDTH)
        amounts = np.asarray(amounts, dtype=float)
        known = np.flatnonzero(amounts > 0)
        amount = np.zeros((len(amounts), WIDTH), dtype=np.float32)
        amount[known] = unit(self.vectors[amount_rows(amounts[known])].sum(axis=1))
        name, rest = many(name_ids, names), 0.6 * many(group_ids, groups) + 0.3 * many(place_ids, places) + 0.9 * amount
        out = [unit(1.1 * name + rest), name, unit(rest), amount]
        if self.centres is None:
            return out
        return [np.where(v.any(axis=1)[:, None], unit(v - c), 0).astype(np.float32) for v, c in zip(out, self.centres)]

    def codes(self, views: list[np.ndarray], bits: int, tables: np.ndarray | None = None) -> np.ndarray:
        """Bucket of each record in each table (of all views, or of ``tables``); -1 where the view is empty."""
        each, weight = tables_for(bits), 1 << np.arange(bits)
        tables = np.arange(VIEWS * each) if tables is None else tables
        out = np.full((len(views[0]), len(tables)), -1, dtype=np.int32)
        for n, view in enumerate(views):
            at = np.flatnonzero(tables // each == n)
            if len(at):
                planes = self.planes[n, tables[at] % each, :, :bits]
                code = ((view @ planes.transpose(1, 0, 2).reshape(WIDTH, -1)) > 0).reshape(len(view), len(at), bits) @ weight
                code[~view.any(axis=1)] = -1
                out[:, at] = code
        return out


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def bits_for(rows: int) -> int:
    """Bits of a table: a bit more for every doubling beyond 4,096 records."""
    return max(TABLES_BITS, min(MOST_BITS, TABLES_BITS + int(math.log2(max(rows, 1) / 4096)))) if rows > 4096 else TABLES_BITS


def prefix_for(rows: int, cell_rows: int = CELL_ROWS) -> int:
    """Bits of a code that route a record of a context of ``rows`` to its cells; 0: one cell holds all tables."""
    return min(max(0, math.ceil(math.log2(max(rows, 1) / cell_rows))), bits_for(rows))


def tables_for(bits: int) -> int:
    """Tables of a view with which a pair of NEAR_COSINE shares a bucket as likely as with TABLES of TABLES_BITS bits."""
    same = 1 - math.acos(NEAR_COSINE) / math.pi
    return max(TABLES, math.ceil(TABLES * math.log1p(-(same**TABLES_BITS)) / math.log1p(-(same**bits))))


def planes_for(rng: np.random.Generator) -> np.ndarray:
    """Hyperplanes of all tables of the views, those of one table at right angles."""
    drawn = rng.standard_normal((VIEWS, tables_for(MOST_BITS), WIDTH, MOST_BITS))
    return np.linalg.qr(drawn)[0].astype(np.float32)


def met(codes_b: np.ndarray, codes_p: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(posted row, board row) of all pairs that share a bucket in some table, each once, by posted rows in order.

    Buckets are found by sorting; what is held at once is bounded by ``most``
    meetings, or those of a single posted row.
    """
    n, tables = codes_b.shape
    # A table's codes have at most 16 bits, so they are sorted by their digits; empty ones are told apart afterwards.
    short = np.maximum(codes_b.T, 0).astype(np.uint16)
    rows = np.argsort(short, axis=1, kind="stable")
    of_table = np.arange(tables, dtype=np.int64) << 32
    flat = (np.take_along_axis(short, rows, axis=1) + of_table[:, None]).ravel()
    empty = np.take_along_axis(codes_b.T < 0, rows, axis=1).ravel()
    rows = rows.ravel()
    wanted = codes_p + of_table
    low, high = np.searchsorted(flat, wanted, "left"), np.searchsorted(flat, wanted, "right")
    size = np.where(codes_p >= 0, high - low, 0)
    upto = np.cumsum(size.sum(axis=1))
    begin = 0
    while begin < len(wanted):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + most, "right")))
        s, first = size[begin:end].ravel(), low[begin:end].ravel()
        at = np.repeat(first - np.concatenate([[0], np.cumsum(s)[:-1]]), s) + np.arange(s.sum())
        pair = np.unique((np.repeat(np.arange(begin, end), size[begin:end].sum(axis=1)) * n + rows[at])[~empty[at]])
        yield pair // n, pair % n
        begin = end


def name_level(a: str | None, b: str | None, loose: bool = True) -> str:
    """How two names compare; ``loose`` also tells those far apart but still alike from others."""
    (code_a, tokens_a), (code_b, tokens_b) = name_parts(a), name_parts(b)
    if not (code_a or tokens_a) or not (code_b or tokens_b):
        return "none"
    if code_a or code_b:
        if code_a == code_b:
            return "same"
        return "near" if code_a.casefold() == code_b.casefold() != "" else _code_level(code_a, tokens_a, code_b, tokens_b)
    if sorted(tokens_a) == sorted(tokens_b):
        return "same"
    like, hint = name_likeness(list(tokens_a), list(tokens_b), {})
    if like:
        return "hint" if hint else "near"
    if not loose:
        return "other"
    a, limit = "".join(tokens_a), max(map(len, ("".join(tokens_a), "".join(tokens_b)))) * 3 // 10
    return "far" if any(edits(a, "".join(order), limit) <= limit for order in {tokens_b, tokens_b[::-1]}) else "other"


def _code_level(code_a: str, tokens_a: tuple, code_b: str, tokens_b: tuple) -> str:
    """A default name against a spelling in which its pattern was lost: small letters, a cut, a misread letter."""
    a = letters(f"commander{code_a}") if code_a else "".join(tokens_a)
    b = letters(f"commander{code_b}") if code_b else "".join(tokens_b)
    if code_a and code_b:
        return "other" if seen(a) != seen(b) else "near"
    return "near" if seen(a) == seen(b) else "other" if not name_likeness([a], [b], {})[0] else "hint"


_NAMES, _AMOUNTS, _PLACES, _GROUPS = (list(x) for x in (NAME, AMOUNT, PLACE, GROUP))


def amount_levels(board: np.ndarray, posted: np.ndarray) -> np.ndarray:
    """How amounts of the board (nan: not known) and posted ones compare, pair by pair, as places in AMOUNT."""
    off = posted - board
    out = np.where(np.isnan(off), _AMOUNTS.index("none"), _AMOUNTS.index("other"))
    out[(off <= 0.004 * board) & (off >= -0.025 * board)] = _AMOUNTS.index("near")
    out[(np.abs(off) <= 500) & (posted % 1000 == 0)] = _AMOUNTS.index("round")
    out[off == 0] = _AMOUNTS.index("same")
    return out


def place_levels(board: np.ndarray, posted: np.ndarray) -> np.ndarray:
    """The same of places, given as numbers, below 0 if not known."""
    return np.where((board < 0) | (posted < 0), _PLACES.index("none"), np.where(board == posted, _PLACES.index("same"), _PLACES.index("other")))


def may_be_alike(a: frozenset[int], b: frozenset[int]) -> bool:
    """Whether two names, by their features, share enough letter triples to be compared."""
    return len(a & b) >= SHARED * min(len(a), len(b))


def candidates(index: Index, board: pd.DataFrame, posted: pd.DataFrame, tables: np.ndarray | None = None, exhaustive: bool = False, rows: int | None = None) -> list[tuple]:
    """Scored pairs of one cell: (posted id, board id, log-odds, cosine).

    A pair is a candidate if it shares a bucket of ``tables`` (by default of
    all), or always if ``exhaustive``; ``rows`` is the size of the context.
    What is cheap to weigh is weighed first; names are compared in order of the
    most a pair can still reach, until no pair left can come within MARGIN of
    the best or of an even chance.
    """
    if not len(board) or not len(posted):
        return []
    views_b, views_p = (index.views(list(d.commander), list(d.alliance), list(d.place), d.points.to_numpy(dtype=float)) for d in (board, posted))
    bits, prior = bits_for(rows or len(board)), -math.log(max(rows or len(board), 2))
    number = {p: n for n, p in enumerate(dict.fromkeys(p for d in (board, posted) for p in d.place if p is not None))}
    place_b, place_p = (np.array([number.get(p, -1) for p in d.place]) for d in (board, posted))
    points_b, points_p = (d.points.to_numpy(dtype=float) for d in (board, posted))
    ids_b, ids_p = (d.id.to_numpy() for d in (board, posted))
    names_b, names_p, groups_b, groups_p = list(board.commander), list(posted.commander), list(board.alliance), list(posted.alliance)
    features_b, features_p = ([frozenset(name_ids(x)) for x in names] for names in (names_b, names_p))
    of_name, slope = dict(zip(NAME, index.name)), index.name[-1]
    of_amount, of_place, of_group = index.rest[:5], index.rest[5:8], dict(zip(GROUP, index.rest[8:11]))
    least, most, group = min(of_name["other"], of_name["none"]), max(of_name.values()), max(of_group.values())
    if exhaustive:
        found = ((np.full(len(board), m), np.arange(len(board))) for m in range(len(posted)))
    else:
        found = met(index.codes(views_b, bits, tables), index.codes(views_p, bits, tables))
    out = []
    for at_p, at_b in found:
        levels = amount_levels(points_b[at_b], points_p[at_p])
        cosine = [np.einsum("nd,nd->n", views_p[v][at_p], views_b[v][at_b]) for v in (0, 1, 2)]
        base = of_amount[levels] + of_place[place_levels(place_b[at_b], place_p[at_p])] + index.rest[-1] * cosine[2] + slope * cosine[1] + prior
        bound = base + most + group
        sure = levels <= _AMOUNTS.index("round")
        begins = np.flatnonzero(np.concatenate([[True], at_p[1:] != at_p[:-1]])) if len(at_p) else []
        for begin, end in zip(begins, [*begins[1:], len(at_p)]):
            m, best, kept = at_p[begin], -math.inf, []
            near = begin + np.flatnonzero(bound[begin:end] >= -MARGIN)
            for k in near[np.argsort(-bound[near], kind="stable")]:
                floor = max(best, 0.0) - MARGIN
                if bound[k] < floor:
                    break
                n = at_b[k]
                if features_b[n] and features_p[m] and not may_be_alike(features_b[n], features_p[m]):
                    weight = of_name["other"]
                else:
                    weight = of_name[name_level(names_p[m], names_b[n], bool(sure[k]))]
                if base[k] + weight + group < floor:
                    continue
                score = base[k] + weight + of_group[same_company(groups_b[n], groups_p[m])]
                best = max(best, score)
                kept.append((int(ids_p[m]), int(ids_b[n]), float(score), float(cosine[0][k])))
            out += [x for x in kept if x[2] >= max(best, 0.0) - MARGIN]
    return out


_PAIR = "posted_id bigint, board_id bigint, score double, cosine double"
_COLUMNS = ["posted_id", "board_id", "score", "cosine"]
_ATTRIBUTES = ["commander", "alliance", "server", "points"]


def _ready(pdf: pd.DataFrame) -> pd.DataFrame:
    text = lambda c: pdf[c].where(pdf[c].notna(), None)
    return pdf.assign(place=[place_of(s) for s in text("server")], points=pdf.points.astype(float), commander=text("commander"), alliance=text("alliance")).reset_index(drop=True)


def _share(df: DataFrame, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the ``rows`` rows of ``df``, by hashed id; the same ones whatever the partitions."""
    return df.where(F.pmod(F.xxhash64("id"), F.lit(max(1, rows // max(wanted, 1)))) == 0)


def fit_index(board: DataFrame, posted: DataFrame, counts: DataFrame, seed: int = 5) -> Index:
    """The index, fitted on walks from about WALK_RECORDS records of both tables, and its weights; see ``fit_weights``.

    ``counts`` has the rows of each context in both tables (``context, n_board,
    n_posted``).  Tasks send only what the samples take, never a prefix each.
    """
    total = counts.agg(F.sum("n_board").alias("b"), F.sum("n_posted").alias("p"), F.count(F.when(F.col("n_board") > 0, 1)).alias("c")).first()
    picked, records = [], []
    for df, rows, share in ((board, total.b or 0, 2), (posted, total.p or 0, 1)):
        found = _share(df, rows, WALK_RECORDS * share // 3).select(*_ATTRIBUTES, "id").collect()
        records += [(r.commander, r.alliance, place_of(r.server), float(r.points) if r.points is not None else math.nan) for r in sorted(found, key=lambda r: r.id)]
    picked = [(name_ids(c), group_ids(a), place_ids(p), amount_ids(n)) for c, a, p, n in records]
    index = Index(train(picked, seed), planes_for(np.random.default_rng(seed + 1)))
    if records:
        views = index.views(*zip(*records))
        index.centres = np.stack([v[v.any(axis=1)].mean(axis=0) if v.any() else np.zeros(WIDTH) for v in views]).astype(np.float32)
    return fit_weights(index, training_pairs(board, _share(posted, total.p or 0, CALIBRATE_ROWS), (total.b or 0) // max(total.c, 1)))


def training_pairs(board: DataFrame, sample: DataFrame, per_context: int) -> pd.DataFrame:
    """Pairs of the posted rows of ``sample`` with board rows: by ``kind`` 'points' and 'name' those that agree in a
    large amount or in the spelling of the name, 'any' random ones of the context, about one each.

    ``sample`` is bounded and broadcast; a partner counts only if no other board row agrees.
    """
    apart = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(max(1, per_context))) == 0
    shown = F.lower(F.trim("commander"))
    kind = lambda k, ok, *on: F.when(ok, F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), "context", *on).alias("key")))
    keys = lambda random: F.filter(F.array(kind("points", F.col("points") >= CERTAIN_POINTS, F.col("points").cast("bigint")), kind("name", shown != "", shown), kind("any", random)), lambda x: x.isNotNull())
    side = lambda df, s, random, *more: df.select(F.explode(keys(random)).alias("x"), *[F.col(c).alias(f"{c}_{s}") for c in ("id", *_ATTRIBUTES, *more)]).select("x.*", *[f"{c}_{s}" for c in ("id", *_ATTRIBUTES, *more)])
    pairs = side(board, "b", apart, "scan", "rank").join(F.broadcast(side(sample, "p", F.lit(True))), ["kind", "key"])
    # A row delivered again is no second partner.
    each = pairs.groupBy("kind", "id_p", "scan_b", "rank_b").agg(F.min(F.struct("id_b", *[f"{c}_{s}" for s in "bp" for c in _ATTRIBUTES])).alias("r"))
    alone = F.when(F.col("kind") == "any", F.row_number().over(Window.partitionBy("kind", "id_p").orderBy("r.id_b")) <= 4).otherwise(F.count("*").over(Window.partitionBy("kind", "id_p")) == 1)
    found = each.withColumn("ok", alone).where("ok").select("kind", "id_p", "r.*").toPandas().sort_values(["kind", "id_p", "id_b"])
    certain = set(zip(found.id_p[found.kind != "any"], found.id_b[found.kind != "any"]))  # a random pair that is one of these is none
    return found[np.array([k != "any" or (i, j) not in certain for k, i, j in zip(found.kind, found.id_p, found.id_b)], dtype=bool)]


def fit_weights(index: Index, pairs: pd.DataFrame) -> Index:
    """``index`` with the weights of names fitted on pairs certain by their amount, those of the rest on pairs certain by
    their name, each against random pairs; without such pairs they stay where they start."""
    sides = {s: _ready(pairs.rename(columns={f"{c}_{s}": c for c in _ATTRIBUTES})[_ATTRIBUTES]) for s in "bp"}
    b, p = sides["b"], sides["p"]
    views_b, views_p = (index.views(list(d.commander), list(d.alliance), list(d.place), d.points.to_numpy()) for d in (b, p))
    cosine = [np.einsum("nd,nd->n", x, y) for x, y in zip(views_p, views_b)]
    levels = np.array([_NAMES.index(name_level(x, y)) for x, y in zip(p.commander, b.commander)], dtype=int)
    number = {x: n for n, x in enumerate(dict.fromkeys([*b.place.dropna(), *p.place.dropna()]))}
    places = place_levels(*(np.array([number.get(x, -1) for x in d.place], dtype=int) for d in (b, p)))
    amounts = amount_levels(b.points.to_numpy(), p.points.to_numpy())
    groups = np.array([_GROUPS.index(same_company(x, y)) for x, y in zip(b.alliance, p.alliance)], dtype=int)
    one = lambda values, n: np.eye(n)[values]
    kinds, here = pairs.kind.to_numpy(), places != _PLACES.index("other")
    for name, certain, x, start in (
        ("name", "points", np.column_stack([one(levels, 6), cosine[1]]), Index.__dataclass_fields__["name"].default_factory()),
        ("rest", "name", np.column_stack([one(amounts, 5), one(places, 3), one(groups, 3), cosine[2]]), Index.__dataclass_fields__["rest"].default_factory()),
    ):
        rows = ((kinds == certain) & here) | (kinds == "any")
        setattr(index, name, logistic(x[rows], (kinds[rows] == certain).astype(float), start))
    return index


def logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of ``x`` as log-odds of ``y`` beyond its share, drawn to ``start`` like normal priors of square spread 1 / PRIOR."""
    shift = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    w = start.astype(float).copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + shift, -50, 50)))
        gradient = x.T @ (y - p) - PRIOR * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRIOR * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def match_records(board: DataFrame, posted: DataFrame, accept: float = ACCEPT, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``board_id, posted_id, confidence``: for each posted record the board record it describes, if one convinces.

    Both tables have ``id, context, commander, alliance, server, points``; the
    board also ``scan`` and ``rank``: of board rows that agree in context, scan
    and rank only that with the least id counts.  Records meet only within a
    context; those with a null context or id meet none.  Any other attribute
    may be null.  Of two equally good partners that with the smaller id is
    taken if the posterior still reaches ``accept``.
    """
    spark = board.sparkSession
    board = board.where("context is not null and id is not null")
    posted = posted.where("context is not null and id is not null")
    each = board.select("context", F.lit(1).alias("b"), F.lit(0).alias("p")).unionAll(posted.select("context", F.lit(0), F.lit(1)))
    counts = durable(each.groupBy("context").agg(F.sum("b").alias("n_board"), F.sum("p").alias("n_posted")))
    shared = spark.sparkContext.broadcast(fit_index(board, posted, counts))
    sizes = counts.where("n_board > 0 and n_posted > 0").select("context", F.greatest("n_board", "n_posted").alias("rows"))
    if counts.count() <= MAX_CONTEXTS:  # else the sizes are joined as a table of their own
        sizes = F.broadcast(sizes)
    pairs = candidate_pairs(board, posted, sizes, shared, cell_rows)
    per = Window.partitionBy("posted_id")
    # A pair that met in several cells has the same score in each.
    best = pairs.groupBy("posted_id", "board_id").agg(F.max("score").alias("score"), F.max("cosine").alias("cosine"))
    ranked = best.withColumn("top", F.max("score").over(per)).withColumn("sum", F.sum(F.exp(F.col("score") - F.greatest(F.lit(0.0), F.max("score").over(per)))).over(per))
    posterior = F.exp(F.col("score") - F.greatest(F.lit(0.0), F.col("top"))) / (F.col("sum") + F.exp(-F.greatest(F.lit(0.0), F.col("top"))))
    first = F.row_number().over(per.orderBy(F.desc("score"), "board_id"))
    chosen = ranked.withColumn("confidence", posterior).withColumn("n", first).where((F.col("n") == 1) & (F.col("confidence") >= accept))
    return chosen.select("board_id", "posted_id", F.round("confidence", 6).alias("confidence"), F.round("cosine", 6).alias("cosine"))


_ROUTED = "context string, cell bigint, rows bigint, scan string, rank int, id bigint, commander string, alliance string, server string, points double"


def candidate_pairs(board: DataFrame, posted: DataFrame, sizes: DataFrame, shared, cell_rows: int) -> DataFrame:
    """Candidates of all contexts: every record goes to its cells, pairs come from the buckets of a cell."""
    columns = ["context", "rows", "scan", "rank", "id", "commander", "alliance", "server", F.col("points").cast("double").alias("points")]
    # Rows delivered again lie in one cell with the first, where it is kept alone; in contexts of several cells they are
    # taken out before, as a copy whose attributes differ may come to cells of its own.
    sized = board.join(sizes, "context")
    divided = F.col("rows") > cell_rows
    first = sized.where(divided).groupBy("context", "scan", "rank").agg(F.min(F.struct("id", *[c for c in sized.columns if c not in ("id", "context", "scan", "rank")])).alias("r")).select("context", "scan", "rank", "r.*")
    one = sized.where(~divided).select(*columns).unionByName(first.select(*columns))
    other = posted.join(sizes, "context").withColumn("scan", F.lit(None).cast("string")).withColumn("rank", F.lit(None).cast("int")).select(*columns)

    def routed(batches):
        for pdf in batches:
            rows = pdf["rows"].to_numpy()
            prefix = np.array([prefix_for(n, cell_rows) for n in rows])
            if (prefix == 0).any():
                yield pdf[prefix == 0].assign(cell=-1)[[c.split()[0] for c in _ROUTED.split(", ")]]
            for p, bits in sorted({(p, bits_for(n)) for n, p in zip(rows, prefix) if p > 0}):
                part = pdf[[q == p and bits_for(n) == bits for n, q in zip(rows, prefix)]]
                d = _ready(part)
                codes = shared.value.codes(shared.value.views(list(d.commander), list(d.alliance), list(d.place), list(d.points)), bits)
                for t in range(codes.shape[1]):
                    there = codes[:, t] >= 0
                    yield part[there].assign(cell=(np.int64(t) << 32) + (codes[there, t] >> (bits - p)))[[c.split()[0] for c in _ROUTED.split(", ")]]

    def block(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=_COLUMNS)
        tables = None if key[1] < 0 else np.array([key[1] >> 32])
        left = left.sort_values("id").drop_duplicates(["scan", "rank"])
        return pd.DataFrame(candidates(shared.value, _ready(left), _ready(right), tables, rows=int(left["rows"].iloc[0])), columns=_COLUMNS)

    sides = [df.mapInPandas(routed, _ROUTED) for df in (one, other)]
    return sides[0].groupBy("context", "cell").cogroup(sides[1].groupBy("context", "cell")).applyInPandas(block, _PAIR)
