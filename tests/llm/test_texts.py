import random
from collections import Counter

import pandas as pd
import pytest
from podium.llm import matching, mixing, mojibake, packing, tokens
from pyspark.sql import functions as F

WORDS = "Die Klägerin begehrt für das Schließfach die Rückgabe gemäß § 12 über 5 € “und” größer später Zürich Суд установил что договор не подлежит исполнению né à l’égard créance".split()


def texts(n=400, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(30)) for _ in range(n)]


GARBLE = {
    "utf-8 as cp1252": lambda t: t.encode().decode("cp1252", "ignore"),
    "utf-8 as latin-1": lambda t: t.encode().decode("latin-1"),
    "utf-8 as mac": lambda t: t.encode().decode("mac_roman"),
    "twice": lambda t: t.encode().decode("latin-1").encode().decode("latin-1"),
    "cp1251 as latin": lambda t: "".join(c.encode("cp1251").decode("cp1252", "ignore") if c.isalpha() and ord(c) > 0x400 else c for c in t),
    "lost": lambda t: t.replace("ü", "�").replace("ä", "�"),
    "asked": lambda t: t.replace("ü", "?").replace("ä", "?"),
}


@pytest.fixture(scope="module")
def model():
    counts = Counter()
    clean = texts()
    for t in clean:
        counts.update(set(mojibake._RUN.findall(t)))
    return mojibake.Model({r: n for r, n in counts.items() if n > 1}, len(clean))


@pytest.mark.parametrize("kind", GARBLE)
def test_garbled_texts_are_found_and_restored(model, kind):
    original = texts(30, seed=9)
    exact = 0
    for t in original:
        bad = GARBLE[kind](t)
        hit, fixed, _ = model.restore(bad)
        assert hit == (bad != t)
        exact += fixed == t
    if kind != "lost" and kind != "asked":
        assert exact >= 0.6 * len(original)


def test_question_marks_of_addresses_are_no_lost_signs():
    for text in ("See https://example.org/search?id=5 or example.org/search?id.", "www.example.org/a?b", "call f?x=1 now"):
        assert not mojibake.lost_sign(text), text
    for text in ("Die Kl?ger m?ssen", "Kläger/Bekl?gte", "a ?? b", "zahlt 5 ? an"):
        assert mojibake.lost_sign(text), text


def test_clean_texts_are_left_alone(model):
    for t in [*texts(50, seed=5), "████ [REDACTED] ****** [...]", "SÃO GALVÃO DECISÃO", "Really? Yes.", ""]:
        assert model.restore(t)[:2] == (False, t)


def test_restored_documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(200))] + [(1000, GARBLE["utf-8 as latin-1"](texts(1, 7)[0]), "x"), (1001, None, "x"), (1002, "", "x"), (1003, "plain " * 20000 + "ZÃ¼rich", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, restored string")
    got = {r.doc_id: r.restored for r in mojibake.restored(df, "doc_id", "text").collect()}
    assert set(got) == {1000, 1003} and got[1003].endswith("Zürich") and got[1000] == texts(1, 7)[0]
    assert mojibake.restored(df.limit(0), "doc_id", "text").count() == 0


def test_packing_is_exact_and_tight(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([0, 1, 7, 30, 64, 99, 100, 101, 250, 1000]), "x") for i in range(3000)] + [(9000, None, "x"), (None, 5, "x"), (1, 7, "x")]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint, container_id string").repartition(3)
    placed = packing.pack(df.drop("container_id"), "doc_id", "n_tokens", {"s": 100, "l": 1000}, windows=16)
    rows = placed.collect()
    for name, capacity in (("s", 100), ("l", 1000)):
        held, pieces = Counter(), {}
        for r in rows:
            if r.container_class == name:
                held[r.container_id] += r.token_to - r.token_from
                pieces.setdefault(r.item_id, []).append((r.token_from, r.token_to))
        assert max(held.values()) <= capacity
        whole = {}
        for i, n, _ in sizes:
            if i is not None and n:
                whole.setdefault(i, []).append(n)
        assert set(pieces) == set(whole)
        for i, parts in pieces.items():
            assert sum(b - a for a, b in parts) == sum(whole[i])
            assert len(parts) == sum(-(-n // capacity) for n in whole[i])  # nothing is cut that fits
        assert sum(held.values()) / (len(held) * capacity) > 0.9
    assert packing.pack(df.limit(0), "doc_id", "n_tokens", {"s": 100}).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, "doc_id", "n_tokens", {"s": 0})


def test_containers_do_not_depend_on_partitions_and_leftovers_are_merged_in_rounds(spark):
    rng = random.Random(12)
    sizes = [(i, rng.randint(1, 60)) for i in range(4000)]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint")
    run = lambda parts, **more: packing.pack(df.repartition(parts), "doc_id", "n_tokens", {"s": 100, "l": 500}, windows=8, partition_rows=100, **more).toPandas()
    order = ["container_class", "container_id", "item_id", "piece_no"]
    one, other = (run(n, merge_rows=150).sort_values(order).values.tolist() for n in (1, 7))
    assert one == other
    for merge_rows in (150, 100_000):  # several rounds, and one
        got = run(3, merge_rows=merge_rows)
        held = (got.token_to - got.token_from).groupby([got.container_class, got.container_id]).sum()
        assert held["s"].max() <= 100 and held["l"].max() <= 500 and len(got) == 2 * len(sizes)
        assert held["s"].mean() / 100 > 0.9 and held["l"].mean() / 500 > 0.9


def test_packer_keeps_its_bound():
    packer = packing.Packer(10, 4)
    for size in [6, 6, 6, 6, 6, 6, 9, 9, 9, 9]:
        packer.place(size)
        assert len(packer.open) <= 4


def test_mixture_reaches_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, rng.choices(["big", "mid", "small"], [90, 9, 1])[0], rng.randint(1, 50)) for i in range(4000)] + [(4001, None, 5), (None, "big", 5), (4003, "other", 9), (4004, "big", 0)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    sources = mixing.read_sources(sizes, "source", targets)
    got = mixing.realise(sizes, "doc_id", "source", sources, mixing.budgets(sources), block_tokens=2000).toPandas()
    share = got.groupby("source").n_tokens.sum() / got.n_tokens.sum()
    for s, limit, wanted in (("big", 1, 0.5), ("mid", 2, 0.3), ("small", 4, 0.2)):
        assert abs(share[s] - wanted) < 0.01
        assert got[got.source == s].groupby("doc_id").size().max() <= limit
        assert not got[got.source == s].duplicated(["doc_id", "pass_no"]).any()
    again = mixing.realise(sizes.repartition(5), "doc_id", "source", sources, mixing.budgets(sources), block_tokens=2000).toPandas()
    assert sorted(map(tuple, got[["doc_id", "pass_no"]].values)) == sorted(map(tuple, again[["doc_id", "pass_no"]].values))


def test_tempered_mixture_is_realised_and_sources_without_tokens_are_left_out(spark):
    rng = random.Random(9)
    rows = [(i, rng.choices(["big", "small"], [95, 5])[0], rng.randint(1, 50)) for i in range(6000)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 2), ("absent", 0.2, 3)], "source string, target_share double, max_repeats int")
    sources = mixing.read_sources(sizes, "source", targets)
    total = sum(s.tokens for s in sources)
    made = mixing.plan(sources, size=total)
    assert 0 < made.exponent < 1 and made.budgets["absent"] == 0
    got = mixing.realise(sizes, "doc_id", "source", sources, made.budgets, block_tokens=2000).toPandas()
    reached = got.groupby("source").n_tokens.sum()
    small = next(s for s in sources if s.name == "small")
    assert 0.99 * 2 * small.tokens <= reached["small"] <= 2 * small.tokens  # its limit is what binds
    assert all(made.budgets[s] - 50 <= n <= made.budgets[s] for s, n in reached.items())
    exact = mixing.plan(sources)
    assert exact.exponent == 1.0 and abs(exact.budgets["big"] / sum(exact.budgets.values()) - 0.5 / 0.8) < 1e-3
    goal = (mixing.entropy(mixing.tempered(mixing.usable(sources), 0.0)) + mixing.entropy(mixing.tempered(mixing.usable(sources), 1.0))) / 2
    by_entropy = mixing.plan(sources, wanted_entropy=goal)
    shares = [n / sum(by_entropy.budgets.values()) for n in by_entropy.budgets.values()]
    assert 0 < by_entropy.exponent < 1 and abs(mixing.entropy(shares) - goal) < 1e-3


def test_temperature():
    s = [mixing.Source("a", 900, None, 1), mixing.Source("b", 90, None, 1), mixing.Source("c", 10, None, 1), mixing.Source("d", 0, None, 1)]
    goal = 0.8
    assert abs(mixing.entropy(mixing.tempered(s, mixing.exponent_for_entropy(s, goal))) - goal) < 1e-6
    assert mixing.tempered(s, 1.0)[0] == 0.9 and mixing.tempered(s, 5.0)[3] == 0.0
    capped = [mixing.Source("a", 900, 0.2, 1), mixing.Source("b", 100, 0.8, 2)]
    a = mixing.exponent_for_limits(capped, 1000)
    assert 0 < a < 1 and mixing.tempered(capped, a)[1] * 1000 <= 200 * (1 + 1e-6)
    assert mixing.budgets([]) == {}


def test_token_sizes(spark):
    if not __import__("os").path.exists(tokens.TOKENIZER):
        pytest.skip("no tokenizer here")
    long = "word " * 100_000
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, long)], "doc_id bigint, text string").withColumn("_text", F.lit("clash")).withColumn("n_tokens", F.lit(-1))
    got = {r.doc_id: r.n_tokens for r in tokens.token_sizes(df, "doc_id", "text").collect()}
    encode = tokens.encoding(tokens.TOKENIZER).encode_ordinary
    assert got == {1: len(encode("Hello world")), 2: 0, 3: 0, 4: len(encode(long))}


def boards(n=300, seed=8):
    rng = random.Random(seed)
    first = ["Samuel", "Dravik", "Kårvik", "Edward", "Quillon", "Margaret", "Ysolke", "Torvald"]
    second = [a + b for a in ("Dusk", "Iron", "Velvet", "Copper", "Frost", "Lantern") for b in ("yoke", "helm", "drum", "spire", "finch", "ward")]
    names = rng.sample([f"{a} {b}" for a in first for b in second], n if n < 288 else 280)
    rows, posts = [], []
    for i, name in enumerate(names):
        event, team = f"e{i % 2}", rng.choice(["[HRT] Hearthward", "[SOA] Salted Orchard", None])
        points = rng.randint(10_000, 3_000_000)
        rows.append((i, event, "s", i, name, team, rng.choice(["1", "2"]), points))
        if i % 3 == 0:
            a, b = name.split()
            shown = rng.choice([name, f"{b} {a}", name.lower(), f"{a[0]}. {b}", name[:-2] + name[-1], ""])
            posts.append((1000 + i, event, shown, team, rng.choice(["S" + rows[-1][6], None]), rng.choice([points, round(points, -3), int(points * 0.99)]) if shown else points))
    return rows, posts


BOARD = "id bigint, context string, scan string, rank int, commander string, alliance string, server string, points bigint"
POSTED = "id bigint, context string, commander string, alliance string, server string, points bigint"


def test_matches_and_recall(spark):
    rows, posts = boards()
    board = spark.createDataFrame([*rows, (5000, *rows[0][1:]), (5001, None, "s", 1, "x", "y", "1", 5), (5002, "e0", "s", 9999, None, None, None, None)], BOARD)
    posted = spark.createDataFrame([*posts, (3000, "e0", "Nobody Atall", "[ZZ] None", "9", 123), (3001, None, "x", "y", "1", 5), (3002, "e0", None, None, None, None)], POSTED)
    cold = {(r.board_id, r.posted_id) for r in matching.match_records(board, posted).collect()}
    truth = {(p[0] - 1000, p[0]) for p in posts}
    assert len(cold & truth) >= 0.95 * len(truth) and len(cold - truth) <= 0.03 * len(truth)
    routed = {(r.board_id, r.posted_id) for r in matching.match_records(board, posted, cell_rows=10).collect()}
    assert routed == cold  # the same pairs meet however a context is divided
    assert matching.match_records(board, posted.limit(0)).count() == matching.match_records(board.limit(0), posted).count() == 0


def test_weights_without_certain_pairs_stay_where_they_start():
    index = matching.Index(matching.train([]), matching.planes_for(__import__("numpy").random.default_rng(1)))
    start = [*index.name, *index.rest]
    pairs = pd.DataFrame([], columns=["kind", "id_p", "id_b", *[f"{c}_{s}" for s in "bp" for c in ("commander", "alliance", "server", "points")]])
    fitted = matching.fit_weights(index, pairs)
    assert [*fitted.name, *fitted.rest] == start


def test_weights_follow_the_data():
    import numpy as np

    x = np.eye(2)[[0] * 900 + [1] * 100 + [0] * 100 + [1] * 900]
    w = matching.logistic(x, np.array([1.0] * 1000 + [0.0] * 1000), np.zeros(2))
    assert abs(w[0] - np.log(9)) < 0.05 and abs(w[1] + np.log(9)) < 0.05
