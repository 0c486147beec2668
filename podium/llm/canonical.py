"""Problem 4: mapping freely entered values to a canonical list.

Entries have a short tag and a name.  Each distinct value is cut into tokens;
each distinct token is joined to the reference vocabulary by edit distance
through a symmetric-delete index (with misreadings, digits used as letters,
abbreviations and run-together words as further ways to repair it); the
repaired tokens of the name are combined by soft TF-IDF and weighed against the
reading of the tag to rank whole entries.  A value whose best entry does not
convince is reported with id 0.

The model is built from the reference list alone, whose size is checked before
it is sent to the workers; the values are aggregated to distinct ones before
the shuffle and repaired once each, so cost follows the number of spellings.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.normalize import TO_LATIN, plain

#: Largest reference list that is sent to every worker.
MAX_ENTRIES = 100_000
#: Words people put around a name, fixed values.
NOISE = frozenset(["the", "alliance", "guild", "clan", "team", "альянс"])
# What is read or written for what.
_DIGIT_AS_LETTER = str.maketrans("0134578@$", "oieastbas")
_SEEN_AS = [("rn", "m"), ("cl", "d"), ("vv", "w")]
_SEEN_CHAR = str.maketrans("i1|!j056289", "lllllosgzbg")
_BRACKETS = regex.compile(r"[\[({<]([^\[\](){}<>]*)[\])}>]")
_TOKEN = regex.compile(r"[^\s,/;:!?\"()\[\]{}<>]+")
_EDGE_OPEN, _EDGE_CLOSE = "[UIJ1l|({<", "]UIJ1l|)}>"


def deletes(word: str, distance: int) -> set[str]:
    """``word`` and every string left by deleting up to ``distance`` letters."""
    out = level = {word}
    for _ in range(distance):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out = out | level
    return out


def edits(a: str, b: str, limit: int) -> int:
    """Edit distance with swaps of neighbours, or ``limit + 1`` beyond it."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    x, y = set(a), set(b)
    if len(x - y) > limit or len(y - x) > limit:  # each letter that the other lacks costs an edit
        return limit + 1
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    left = end - start
    stop = 0
    while stop < left and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if not a or not b:
        return len(a) + len(b) if len(a) + len(b) <= limit else limit + 1
    if len(a) == len(b) == 1:
        return 1 if limit >= 1 else limit + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > limit:
            return limit + 1
        before, row = row, new
    return row[-1] if row[-1] <= limit else limit + 1


def reach(length: int) -> int:
    """Edits allowed in a word of this length."""
    return 0 if length < 3 else 1 if length < 6 else 2


def look(word: str) -> str:
    """A word in capitals, each look-alike letter as its Latin one."""
    return word.upper().translate(TO_LATIN)


def sight(tag: str) -> str:
    """A tag as it looks: letters of other scripts as Latin ones, misread characters brought together."""
    return seen(tag.translate(TO_LATIN).casefold())


def seen(word: str) -> str:
    """``word`` with what is easily misread brought together."""
    for a, b in _SEEN_AS:
        word = word.replace(a, b)
    return word.translate(_SEEN_CHAR)


class Reference:
    """The canonical list as a vocabulary of words and tags."""

    def __init__(self, entries: list[tuple[int, str, str]]) -> None:
        self.words: list[list[str]] = []
        self.ids, self.tags = [e[0] for e in entries], [plain(e[1] or "") for e in entries]
        holding = defaultdict(set)
        for n, (_, _, name) in enumerate(entries):
            self.words.append([t.casefold() for t in _TOKEN.findall(plain(name or ""))])
            for w in self.words[-1]:
                holding[w].add(n)
        self.holding = dict(holding)
        self.idf = {w: math.log(1 + len(entries) / len(e)) for w, e in holding.items()}
        self.unknown = math.log(1 + len(entries))
        self.norm = [math.sqrt(sum(self.idf[w] ** 2 for w in ws)) or 1.0 for ws in self.words]
        self.by_delete = defaultdict(set)
        self.by_sight, self.by_prefix, self.by_look = defaultdict(set), defaultdict(set), defaultdict(set)
        for w in holding:
            for d in deletes(w, reach(len(w))):
                self.by_delete[d].add(w)
            self.by_sight[seen(w)].add(w)
            self.by_look[look(w)].add(w)
            for k in range(1, len(w)):
                self.by_prefix[w[:k]].add(w)
        self.tag_exact, self.tag_sight, self.tag_delete = defaultdict(set), defaultdict(set), defaultdict(set)
        for n, t in enumerate(self.tags):
            if t:
                self.tag_exact[t].add(n)
                self.tag_sight[sight(t)].add(n)
                for d in deletes(sight(t), 1):
                    self.tag_delete[d].add(n)
        self.repaired: dict[str, dict[str, float]] = {}
        self.mapped: dict[str, tuple[int, float]] = {}
        self.exact = {plain(f"[{t}] {n}"): i for i, t, n in reversed(entries)}

    def repair(self, token: str) -> dict[str, float]:
        """Vocabulary words that ``token`` may stand for, with a likeness up to 1."""
        known = self.repaired.get(token)
        if known is not None:
            return known
        out: dict[str, float] = {}
        short = token.endswith(".")
        word = token.rstrip(".'`~*_=").lstrip("'`~*_=-")

        def keep(w: str, s: float) -> None:
            out[w] = max(out.get(w, 0.0), s)

        if word in self.idf:
            keep(word, 1.0)
        elif word:
            letters = word.translate(_DIGIT_AS_LETTER)
            for w in self.by_sight.get(seen(word), ()):
                keep(w, 0.95)
            for w in self.by_look.get(look(word), ()):
                keep(w, 0.95)
            if letters in self.idf:
                keep(letters, 0.95)
            for form, worth in ((word, 1.0), (letters, 0.95), (seen(word), 0.9)):
                for d in deletes(form, reach(len(form))):
                    for w in self.by_delete.get(d, ()):
                        far = edits(form, w, 2)
                        if far <= min(reach(len(form)), reach(len(w))):
                            keep(w, worth * (1 - far / (max(len(form), len(w)) + 1)))
            if len(word) >= (1 if short else 3):
                for w in self.by_prefix.get(word, ()):
                    keep(w, 0.75 if short else 0.5 + 0.4 * len(word) / len(w))
        if len(self.repaired) > 300_000:
            self.repaired.clear()
        self.repaired[token] = out
        return out

    def split(self, token: str) -> list[str]:
        """A token that nothing repairs, cut in two or three words that something does, or as it is."""
        if self.repair(token) or len(token) < 6:
            return [token]
        for k in range(2, len(token) - 1):
            left, right = token[:k], token[k:]
            if max(self.repair(left).values(), default=0) >= 0.95:
                if max(self.repair(right).values(), default=0) >= 0.8:
                    return [left, right]
                rest = self.split(right) if len(right) >= 6 else [right]
                if len(rest) > 1:
                    return [left, *rest]
            elif max(self.repair(right).values(), default=0) >= 0.95 and max(self.repair(left).values(), default=0) >= 0.8 and k > 3:
                return [left, right]
        return [token]

    def tag_likeness(self, text: str) -> dict[int, float]:
        """Entries whose tag ``text`` may be, with a likeness up to 1."""
        out: dict[int, float] = {}
        low = sight(text)
        if len(low) >= 3:
            for d in deletes(low, 1):
                for n in self.tag_delete.get(d, ()):
                    if edits(low, sight(self.tags[n]), 1) <= 1:
                        out[n] = 0.6
        for n in self.tag_sight.get(low, ()):
            out[n] = 0.9
        for n in self.tag_exact.get(text, ()):
            out[n] = 1.0
        return out

    def readings(self, value: str) -> Iterator[tuple[str, list[str], bool]]:
        """The ways to read ``value``: (tag or empty, words of the name, whether the tag stood in brackets)."""
        text = plain(value)
        m = next((m for m in _BRACKETS.finditer(text) if len("".join(m.group(1).split())) >= 2), None)
        if m and (m.start() == 0 or m.end() == len(text)):
            yield "".join(m.group(1).split()), _TOKEN.findall(text[: m.start()] + " " + text[m.end() :]), True
            return
        tokens = [t for t in _TOKEN.findall(_BRACKETS.sub(" ", text)) if t.strip("-.~_=*|")]
        yield "", tokens, False
        raw = text.split()
        for at, whole in ((0, raw[:1]), (-1, raw[-1:])):
            if whole and len(tokens) > 1 or whole and len(whole[0]) <= 6:
                bare = whole[0].strip(",;:-/()[]{}<>")
                rest = tokens[1:] if at == 0 else tokens[:-1]
                if 2 <= len(bare) <= 6:
                    yield bare, rest, whole[0] != bare and whole[0][0] in "[(<{" or whole[0][-1:] in "])>}"
                inner = whole[0]
                if len(inner) >= 4 and inner[0] in _EDGE_OPEN and inner[-1] in _EDGE_CLOSE and at == 0:
                    yield inner[1:-1], rest, True

    def rank(self, value: str) -> list[tuple[float, float, float, int]]:
        """Candidate entries, best first: (score, name likeness, tag likeness, entry)."""
        best: dict[int, tuple[float, float, float]] = {}
        for tag, tokens, bracketed in self.readings(value):
            words = [w for t in tokens for p in [t.casefold().strip("-|~_=*")] if p and p not in NOISE for w in self.split(p)]
            tag_like = self.tag_likeness(tag) if tag else {}
            name_like: dict[int, float] = defaultdict(float)
            size = 0.0
            for w in words:
                options = self.repair(w)
                weight = max((self.idf[v] for v in options), default=self.unknown)
                size += weight**2
                per: dict[int, float] = {}
                for v, s in options.items():
                    for n in self.holding[v]:
                        per[n] = max(per.get(n, 0.0), s * self.idf[v] * weight)
                for n, x in per.items():
                    name_like[n] += x
            size = math.sqrt(size) or 1.0
            for n in name_like.keys() | tag_like.keys():
                name = min(1.0, name_like.get(n, 0.0) / (size * self.norm[n]))
                t = tag_like.get(n, 0.0)
                score = self.weigh(name, t, bool(words), bool(tag), bracketed)
                if n not in best or score > best[n][0]:
                    best[n] = (score, name, t)
        return sorted(((s, nm, t, n) for n, (s, nm, t) in best.items()), key=lambda x: (-x[0], -x[1], -x[2], self.ids[x[3]]))

    def weigh(self, name: float, tag: float, has_name: bool, has_tag: bool, bracketed: bool) -> float:
        """The confidence that name and tag, as far as read, are those of the entry."""
        if not has_name:
            return (tag if bracketed else tag * 0.95) * 0.9
        if not has_tag:
            return name
        if tag == 0:
            return name * (0.75 if bracketed else 0.6)
        return 0.65 * name + 0.35 * tag

    def map(self, value: str, accept: float, margin: float) -> tuple[int, float]:
        """(id of the entry meant or 0, confidence)."""
        text = plain(value)
        if text in self.exact:
            return self.exact[text], 1.0
        known = self.mapped.get(text)
        if known is None:
            ranked = self.rank(text)
            known = (self.ids[ranked[0][3]], ranked[0][0]) if ranked else (0, 0.0)
            if known[1] < accept or (len(ranked) > 1 and ranked[0][0] - ranked[1][0] < margin):
                known = 0, known[1]
            if len(self.mapped) > 300_000:
                self.mapped.clear()
            self.mapped[text] = known
        return known


def load_reference(entries: DataFrame, id_column: str, tag: str, name: str, limit: int = MAX_ENTRIES) -> list[tuple[int, str, str]]:
    """The reference list on the driver, by ascending id; raises beyond ``limit`` rows."""
    rows = entries.select(id_column, tag, name).where(F.col(id_column).isNotNull()).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a reference list of more than {limit} entries can't be sent to every worker")
    return sorted((r[0], r[1] or "", r[2] or "") for r in rows)


def map_values(values: DataFrame, column: str, reference: list[tuple[int, str, str]], accept: float = 0.65, margin: float = 1e-9) -> DataFrame:
    """Each distinct non-empty ``column`` of ``values`` with ``entry_id`` (0: none) and ``confidence``.

    Nulls and empty values mean nothing and are left out.  Of two entries that
    fit equally well (closer than ``margin``) neither is chosen.
    """
    spark = values.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a value takes long for its size, so values are not put together for it
    distinct = values.select(F.col(column).alias("value")).where(F.col("value") != "").distinct().repartition(tasks)
    shared = spark.sparkContext.broadcast(reference)  # its size was checked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Reference(shared.value)
        for batch in batches:
            got = [model.map(v, accept, margin) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())], names=["value", "entry_id", "confidence"])

    return distinct.mapInArrow(run, "value string, entry_id bigint, confidence double")
