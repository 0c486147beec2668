"""Problem 5: which spellings of names typed by people belong together.

Every spelling is brought to tokens (plain form, decorations, accents and
digits used as letters undone).  A symmetric-delete index over the distinct
tokens of the corpus finds those that may be one word: as many deletes as the
judge allows edits, one in short and two in long words.  Two spellings of one
block are compared if two of their tokens are near in this sense (or the only
one of each), or if one token is near and another begins alike and one of both
may be a short form: an initial, a cut-off or a rare word.  A run-together
spelling is looked up by all its splits.  Candidates are judged by an optimal
assignment of their tokens that permits typing errors, initials, cut-off words
and nicknames.  Full forms are linked first; a spelling that only hints at a
name (initials, cut-offs) joins a full form if that is the only one it fits, or
the only one seen in the same company.  Groups are the connected components of
the links.

A typing error is told from another word by counts over the whole corpus: two
words that are both common are different words, however close.  A word is rare
if its share of the spellings of its kind is, by the lower end of its 95 %
range, below RARE; so the rule is one of shares, softened where counts are too
small to tell.

Plan: the index holds each distinct token once, so its size follows the
vocabulary; spellings carry only the few keys of their tokens, hashed to 64
bits.  Candidate pairs come from equi-joins on the keys; a frequent word makes
large keys only with another frequent word, or on the side of spellings that
are no short form.  Links and labels stay in DataFrames.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations
from math import sqrt

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.canonical import NOISE, deletes, edits, seen
from podium.llm.normalize import plain
from podium.operators.components import connected_components
from podium.session import durable

# Short forms of first names.
NICKNAMES = {
    "alex": "alexander", "andy": "andrew", "barb": "barbara", "becky": "rebecca", "ben": "benjamin", "benny": "benjamin",
    "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert",
    "cathy": "catherine", "charlie": "charles", "chuck": "charles", "chris": "christopher", "dan": "daniel", "danny": "daniel",
    "dave": "david", "dick": "richard", "dot": "dorothea", "ed": "edward", "eddie": "edward", "eliza": "elizabeth",
    "fred": "frederick", "freddy": "frederick", "gabe": "gabriel", "greg": "gregory", "harry": "harold", "jack": "john",
    "jake": "jacob", "jim": "james", "jimmy": "james", "joe": "joseph", "joey": "joseph", "jon": "jonathan",
    "jonny": "jonathan", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "kit": "christopher",
    "larry": "lawrence", "lex": "alexander", "liz": "elizabeth", "lizzie": "elizabeth", "maggie": "margaret", "marge": "margaret",
    "matt": "matthew", "meg": "margaret", "mick": "michael", "mike": "michael", "mickey": "michael", "nat": "nathaniel",
    "ned": "edward", "nick": "nicholas", "nico": "nicholas", "nicky": "nicholas", "pat": "patricia", "patty": "patricia", "peg": "margaret",
    "peggy": "margaret", "penny": "penelope", "pete": "peter", "ray": "raymond", "rich": "richard", "rick": "richard",
    "rob": "robert", "robbie": "robert", "ron": "ronald", "sally": "sarah", "sam": "samuel", "sammy": "samuel",
    "sandy": "alexander", "steve": "stephen", "sue": "susan", "susie": "susan", "suzie": "susan", "suzy": "susan", "tori": "victoria", "ted": "theodore", "teddy": "theodore",
    "theo": "theodore", "tom": "thomas", "tommy": "thomas", "tony": "anthony", "trish": "patricia", "vic": "victoria",
    "vicky": "victoria", "wes": "wesley", "will": "william", "willy": "william", "zach": "zachary", "bella": "isabella",
    "izzy": "isabella", "dolly": "dorothea", "thea": "dorothea", "bert": "albert", "al": "albert", "gene": "eugene",
}
#: Share of the spellings of a kind below which a word is rare.
RARE = 1e-4
#: Letters of a long word that are indexed with two deletes, and from which length on a word is long.
PREFIX, LONG = 7, 7
#: What people add to a name for their channel, fixed values.
CHANNELS = frozenset(["tv", "yt", "ttv", "live"])
_DIGIT_AS_LETTER = str.maketrans("01345789@$", "oleastbgas")
_LETTER_BARS = str.maketrans("øłđħŧ", "oldht")
_WRAP = regex.compile(r"^(?:xX_|_?xx_)(.*)(?:_Xx|_xx_?)$", regex.I)
_CUT = regex.compile(r"[^\p{L}\p{M}\p{N}|!@$]+")
_LETTER = regex.compile(r"[\p{L}\p{N}]")
_DEFAULT = regex.compile(r"Commander([0-9A-Za-z]{4,})")
_TAGGED = regex.compile(r"^\s*[\[({<]([^\[\](){}<>]{2,12})[\])}>]\s*(.*)$|^(.*?)\s*[\[({<]([^\[\](){}<>]{2,12})[\])}>]\s*$")
_SUFFIX = regex.compile(r"\s*\(\p{L}\)\s*$")


def letters(word: str) -> str:
    """``word`` in small letters without accents, digits among letters as the letters they stand for."""
    low = word.rstrip("!").casefold()
    if not low.isascii():
        low = unicodedata.normalize("NFD", low)
        low = "".join(c for c in low if not unicodedata.combining(c) or c == "̆").translate(_LETTER_BARS)
        low = unicodedata.normalize("NFC", low)
    return low.translate(_DIGIT_AS_LETTER).replace("|", "l").replace("!", "i") if any(c.isalpha() for c in low) else low


def person_tokens(text: str) -> tuple[str, list[str]]:
    """(code of a default name or empty, tokens) of a person's name."""
    shown = plain(text)
    m = _DEFAULT.fullmatch(shown)
    if m:
        return m.group(1), []
    while w := _WRAP.match(shown):
        shown = w.group(1)
    bare = shown.strip("|!@$ ")
    tokens = [t for w in _CUT.split(bare) if _LETTER.search(w) and (t := letters(w))]
    if len(tokens) > 1 and tokens[-1] in CHANNELS:
        tokens.pop()
    return "", tokens or [shown.casefold()]


def group_tokens(text: str) -> tuple[str, list[str]]:
    """(tag or empty, tokens of the name) of a group's label."""
    shown = plain(text)
    m = _TAGGED.match(shown)
    tag, rest = ("", shown)
    if m:
        tag, rest = (m.group(1), m.group(2)) if m.group(1) else (m.group(4), m.group(3))
        if len("".join(tag.split())) < 3:
            tag, rest = "", rest
    else:
        words = shown.split()
        for at in (0, -1) if len(words) > 1 else ():
            bare = words[at].strip("[](){}<>,/-")
            other = words[1:] if at == 0 else words[:-1]
            fused = len(words[at]) >= 4 and words[at][0] in "[UIJ1l|" and words[at][-1] in "]UIJ1l|"
            opened = words[at][0] in "[({<" or words[at][-1] in "])}>"
            parted = words[1 if at == 0 else -2] in "/-" if len(words) > 2 else False
            shout = 3 <= len(bare) <= 4 and not bare.istitle() and not bare.islower() and not (shown.isupper())
            comma = at == -1 and words[-2].endswith(",") and 3 <= len(bare) <= 4
            if fused and at == 0:
                tag, rest = words[at][1:-1], " ".join(other)
                break
            if opened and len(bare) >= 3 or parted and 3 <= len(bare) <= 4 or shout or comma:
                tag, rest = bare, " ".join(other)
                break
    rest = _SUFFIX.sub("", rest).strip("! ")
    tokens = [t for w in _CUT.split(rest) if _LETTER.search(w) and (t := letters(w)) and t not in NOISE]
    tag = "".join(tag.split())
    return tag, tokens if tokens or tag else [shown.casefold()]


def is_rare(n: float, total: int) -> bool:
    """Whether a word in ``n`` of ``total`` spellings is rare: the lower end of the range of its share is at most RARE."""
    return n - 1.64 * sqrt(n) <= RARE * total


def token_likeness(a: str, b: str, count: dict[str, int], total: int = 0) -> tuple[float, bool]:
    """(likeness or 0, whether it is only a hint) of two tokens; ``count`` is of ``total`` spellings."""
    if a == b:
        return 1.0, False
    if a > b:
        a, b = b, a
    sa, sb = seen(a), seen(b)
    if sa == sb and min(len(a), len(b)) > 2:
        return 0.97, False
    if a in NICKNAMES and b.startswith(NICKNAMES[a]) or b in NICKNAMES and a.startswith(NICKNAMES[b]):
        return 0.9, False
    few, many = sorted((count.get(a, 1), count.get(b, 1)))
    rare = is_rare(few, total)
    if min(len(a), len(b)) >= 4:
        far = min(edits(a, b, 2), edits(sa, sb, 2))
        if far == 1 and (rare or many >= 8 * few):
            return 1 - 1 / (max(len(a), len(b)) + 1), False
        if far == 2 and min(len(a), len(b)) >= LONG and many >= 10 * few:
            return 1 - 2 / (max(len(a), len(b)) + 1), False
    short, long = (a, b) if len(a) < len(b) else (b, a)
    if len(short) == 1 and long.startswith(short):
        return 0.6, True
    if len(short) >= 2 and long.startswith(short) and len(long) - len(short) >= 2 and (rare or many >= 6 * few):
        return 0.7, True
    if len(short) == 3 and len(long) <= 4 and edits(short, long, 1) <= 1:
        return 0.6, True
    if len(short) >= 3 and rare and len(long) - len(short) >= 2 and edits(short, long[: len(short)], 1) <= 1:
        return 0.5, True
    return 0.0, False


@lru_cache(maxsize=500_000)
def token_likeness_alone(a: str, b: str) -> tuple[float, bool]:
    """``token_likeness`` where no counts are known."""
    return token_likeness(a, b, {})


#: Cost of a pair of tokens that can't be one, and what a hint costs more than any typing error.
_NEVER, _HINT = 1e6, 10.0


def assignment(cost: list[list[float]]) -> list[int]:
    """The column of each row at the least total cost of a square matrix: shortest augmenting paths, O(n^3)."""
    n = len(cost)
    if n <= 3:
        return list(min(permutations(range(n)), key=lambda order: sum(cost[i][j] for i, j in enumerate(order))))
    row_of, u, v = [-1] * (n + 1), [0.0] * n, [0.0] * (n + 1)
    for i in range(n):
        row_of[n], column = i, n
        least, before, used = [float("inf")] * (n + 1), [n] * (n + 1), [False] * (n + 1)
        while row_of[column] != -1:
            used[column] = True
            at, step, nearest = row_of[column], float("inf"), n
            for j in range(n):
                if not used[j]:
                    d = cost[at][j] - u[at] - v[j]
                    if d < least[j]:
                        least[j], before[j] = d, column
                    if least[j] < step:
                        step, nearest = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[row_of[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            column = nearest
        while column != n:
            row_of[column], column = row_of[before[column]], before[column]
    out = [0] * n
    for j in range(n):
        out[row_of[j]] = j
    return out


def composed(whole: str, tokens: list[str], errors: int) -> bool:
    """Whether ``whole`` is ``tokens`` run together in some order, with up to ``errors`` edits, each within a token."""
    if len(tokens) <= 3:
        return any(edits(whole, "".join(order), errors) <= errors for order in permutations(tokens))
    known: set[tuple] = set()

    def from_here(at: int, left: tuple[str, ...], errors: int) -> bool:
        if not left:
            return len(whole) - at <= errors
        if (at, left, errors) in known:
            return False
        for t in dict.fromkeys(left):
            rest = list(left)
            rest.remove(t)
            for size in range(max(0, len(t) - errors), len(t) + errors + 1):
                spent = edits(whole[at : at + size], t, errors)
                if at + size <= len(whole) and spent <= errors and from_here(at + size, tuple(rest), errors - spent):
                    return True
        known.add((at, left, errors))
        return False

    return from_here(0, tuple(sorted(tokens)), errors)


def name_likeness(a: list[str], b: list[str], count: dict[str, int], total: int = 0) -> tuple[float, bool]:
    """(mean likeness under the best assignment or 0, whether it rests on hints) of two token lists.

    Every token of both must be matched, by as few hints as possible and not by
    hints alone; a run-together spelling is compared as a whole.
    """
    if not a or not b:
        return 0.0, False
    if len(a) == len(b):
        pairs = [[token_likeness(x, y, count, total) if count else token_likeness_alone(x, y) for y in b] for x in a]
        cost = [[1 - like + hint * _HINT if like else _NEVER for like, hint in row] for row in pairs]
        chosen = [pairs[i][j] for i, j in enumerate(assignment(cost))]
        if all(like for like, _ in chosen) and not all(hint for _, hint in chosen):
            return sum(like for like, _ in chosen) / len(chosen), any(hint for _, hint in chosen)
    one, other = (a, b) if len(a) < len(b) else (b, a)
    whole = "".join(one)
    if len(whole) >= 6:
        if len(whole) == sum(map(len, other)) and composed(whole, other, 0):
            return 0.99, False
        if len(one) < len(other) and abs(len(whole) - sum(map(len, other))) <= 1 and composed(whole, other, 1):
            return 0.9, True
    return 0.0, False


@lru_cache(maxsize=100_000)
def label_words(text: str) -> frozenset[str]:
    """The words of a group's label, misread characters brought together."""
    return frozenset(seen(t) for w in _CUT.split(plain(text)) if len(t := letters(w)) > 1 and t not in NOISE)


def same_company(a: str | None, b: str | None) -> int:
    """1 if two group labels look the same, -1 if different, 0 if one is not known.

    They look the same if the words of one are among those of the other, or if
    two words are shared, up to misread characters.
    """
    if not a or not b or "No Alliance" in (a, b):
        return 0
    x, y = label_words(a), label_words(b)
    shared = len(x & y)
    return 1 if shared and (shared >= 2 or shared == min(len(x), len(y))) else -1


def token_keys(token: str) -> set[str]:
    """The index keys of a token: tokens as near as ``token_likeness`` accepts without a hint share one.

    Keys that begin with 1 are the word as it looks without up to one letter;
    those that begin with 2, of long words, its beginning without up to two,
    because the beginnings of words two edits apart are as close.  Short forms
    of first names meet the full forms they stand for.
    """
    look = seen(token)
    out = {f"1{d}" for d in deletes(look, 1)} if len(token) >= 4 else {f"1{look}"} if len(token) > 2 else set()
    if len(token) >= LONG:
        out |= {f"2{d}" for d in deletes(look[:PREFIX], 2)}
    if token in NICKNAMES:
        out.add(f"n{NICKNAMES[token]}")
    return out | {f"n{token[:n]}" for n in _FULL_LENGTHS if token[:n] in _FULL}


_FULL = frozenset(NICKNAMES.values())
_FULL_LENGTHS = sorted({len(f) for f in _FULL})


def full_keys(forms: list[list[str]]) -> set[str]:
    """Keys of a spelling by its near tokens: every two of them, or the only one.  ``forms`` has of each token itself and its more frequent neighbours."""
    if len(forms) == 1:
        return {f"s{t}" for t in forms[0]}
    return {f"f{'|'.join(sorted((x, y)))}" for one, other in combinations(forms, 2) for x in one for y in other if len(x) > 1 and len(y) > 1}


def hint_keys(tokens: list[str], forms: list[list[str]]) -> set[str]:
    """Keys of a spelling by one near token and the beginning of another."""
    out = set()
    for i, one in enumerate(forms):
        if len(tokens[i]) >= 3:
            for j, o in enumerate(tokens):
                if i != j:
                    marks = {o[0]} | ({NICKNAMES[o][0]} if o in NICKNAMES else set())
                    out |= {f"t{t}|{m}" for t in one for m in marks}
    return out


def split_keys(token: str) -> set[str]:
    """The keys that a run-together spelling shares with its parts, one of which at least is whole if there is one edit."""
    if len(token) < 6:
        return set()
    return {f"t{token[:k]}|{token[k]}" for k in range(3, len(token))} | {f"t{token[k:]}|{token[0]}" for k in range(1, len(token) - 2)}


_TOKENS = "id bigint, block string, company string, code string, tag string, tokens array<string>"


def _tokenised(kind_column: str, person: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, blocks, texts, companies = (batch.column(i).to_pylist() for i in range(5))
            made = [(*person_tokens(x), "") if k == person else ("", *reversed(group_tokens(x))) for k, x in zip(kinds, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(blocks, pa.string()),
                    pa.array(companies, pa.string()),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[2] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.list_(pa.string())),
                ],
                names=["id", "block", "company", "code", "tag", "tokens"],
            )

    return run


def _near_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs of tokens (kind, a, n_a, b, n_b, total) those that may be one word, as (kind, token, common), the more frequent one last."""
    for batch in batches:
        kinds, a, n_a, b, n_b, total = (batch.column(i).to_pylist() for i in range(6))
        kept = [n for n in range(batch.num_rows) for like, hint in [token_likeness(a[n], b[n], {a[n]: n_a[n], b[n]: n_b[n]}, total[n])] if like and not hint]
        ordered = [sorted(((n_a[n], a[n]), (n_b[n], b[n]))) for n in kept]
        columns = [[kinds[n] for n in kept], [few for (_, few), _ in ordered], [many for _, (_, many) in ordered]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["kind", "token", "common"])


def _token_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, tokens, counts = (batch.column(i).to_pylist() for i in range(3))
        seeds = {k: xxhash.xxh32_intdigest(k) for k in set(kinds)}
        out = [(xxhash.xxh64_intdigest(k, seeds[kind]) - 2**63, kind, t, seen(t), n, k[0]) for kind, t, n in zip(kinds, tokens, counts) for k in token_keys(t)]
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))], names=["key", "kind", "token", "look", "n", "family"])


def met_in_keys(keyed: DataFrame, *conditions: str) -> DataFrame:
    """``keyed`` joined to itself on ``key``, as x and y; keys that only one row has are dropped before, in the same exchange."""
    kept = keyed.withColumn("_c", F.count("*").over(Window.partitionBy("key"))).where("_c > 1").drop("_c")
    return kept.alias("x").join(kept.alias("y"), F.expr(" and ".join(["x.key = y.key", *conditions])))


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``kind, token, common``: every two tokens of a kind that may be one word, of a ``vocabulary`` (kind, token, n, total).

    Two edits are accepted only where one word is ten times as frequent, so
    keys of two deletes only join such words; what is farther apart than any
    accepted pair, swaps counted as two, is left out before it is judged.
    """
    tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a token has many keys, so tokens are not put together for their size before
    keyed = durable(vocabulary.select("kind", "token", "n").repartition(tasks, "token").mapInArrow(_token_keys, "key bigint, kind string, token string, look string, n bigint, family string"))
    uneven = "greatest(x.n, y.n) >= 10 * least(x.n, y.n)"
    near = f"(x.family = 'n' or levenshtein(x.look, y.look) <= if({uneven}, 4, 2))"
    pairs = met_in_keys(keyed, "x.token < y.token", f"(x.family <> '2' or {uneven})", near).select("x.kind", F.col("x.token").alias("a"), F.col("x.n").alias("n_a"), F.col("y.token").alias("b"), F.col("y.n").alias("n_b")).distinct()
    return durable(pairs.join(F.broadcast(vocabulary.groupBy("kind").agg(F.max("total").alias("total"))), "kind").select("kind", "a", "n_a", "b", "n_b", "total").mapInArrow(_near_tokens, "kind string, token string, common string"))


def _keys_of(person: str):
    """Index keys of spellings (id, block, tag, tokens, forms, short): (key, id, short); ``short`` is null for keys of near
    tokens, else whether the spelling may hold a short form.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids, shorts = [], [], []
            for i, block, tag, tokens, forms, short in zip(*(batch.column(n).to_pylist() for n in ("id", "block", "tag", "tokens", "forms", "short"))):
                full, hints, splits = full_keys(forms), hint_keys(tokens, forms), split_keys(tokens[0]) if len(tokens) == 1 else set()
                if tag:
                    full.add(f"g{seen(tag.casefold())}")
                elif len(tokens) > 1 and not block.startswith(f"{person}|"):  # one end may be a tag without its brackets
                    for part in (slice(1, None), slice(0, -1)):
                        full |= full_keys(forms[part])
                        splits |= split_keys(tokens[part][0]) if len(tokens) == 2 else set()
                seed = xxhash.xxh64_intdigest(block)
                for keys, mark in ((full, None), (hints - splits, short), (splits, True)):
                    hashes += [xxhash.xxh64_intdigest(k, seed) - 2**63 for k in keys]
                    ids += [i] * len(keys)
                    shorts += [mark] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(ids, pa.int64()), pa.array(shorts, pa.bool_())], names=["key", "id", "short"])

    return run


def candidate_pairs(spellings: DataFrame, person: str) -> DataFrame:
    """``id_a, id_b``, id_a < id_b, of the ``spellings`` (id, block, tag, tokens, forms, short) that are to be compared."""
    keyed = durable(spellings.select("id", "block", "tag", "tokens", "forms", "short").mapInArrow(_keys_of(person), "key bigint, id bigint, short boolean"))
    return met_in_keys(keyed, "x.id < y.id", "(x.short is null or x.short or y.short)").select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b")).distinct()


def judge(tag_a: str, a: list[str], tag_b: str, b: list[str], count: dict[str, int], total: int = 0) -> tuple[float, bool]:
    """(likeness or 0, whether a hint) of two spellings; tags must agree where both are read."""
    if tag_a and tag_b:
        x, y = seen(tag_a.casefold()), seen(tag_b.casefold())
        if x != y and edits(x, y, 1) > 1:
            return 0.0, False
        if not a or not b:
            return (0.95, False) if tag_a.casefold() == tag_b.casefold() else (0.0, False)
        best = name_likeness(a, b, count, total)
        if best[0] == 0 and x == y and len(a) != len(b):  # a label cut off at its end
            n = min(len(a), len(b))
            best = (0.5, True) if name_likeness(a[:n], b[:n], count, total)[0] > 0 else best
        return best
    best = name_likeness(a, b, count, total)
    if best[0] == 0 and (tag_a or tag_b):  # the other's tag may stand without brackets
        tag, with_tag, other = (tag_a, a, b) if tag_a else (tag_b, b, a)
        mark = seen(letters(tag))
        for end, rest in ((other[0], other[1:]), (other[-1], other[:-1])) if len(other) > 1 else ():
            if seen(end) == mark:
                best = max(best, name_likeness(with_tag, rest, count, total))
    return best


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for n in range(batch.num_rows):
            a, b = columns["tokens_a"][n], columns["tokens_b"][n]
            count = dict(zip(a, columns["counts_a"][n])) | dict(zip(b, columns["counts_b"][n]))
            like, hint = judge(columns["tag_a"][n], a, columns["tag_b"][n], b, count, columns["total_a"][n])
            if like > 0:
                small_first = (len(a), sum(map(len, a)), columns["id_a"][n]) <= (len(b), sum(map(len, b)), columns["id_b"][n])
                i, j = (columns["id_a"][n], columns["id_b"][n])[:: 1 if small_first else -1]
                out.append((i, j, like, hint, same_company(columns["company_a"][n], columns["company_b"][n]) if hint else 0))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32()))], names=["a", "b", "likeness", "hint", "company"])


def spellings(names: DataFrame, key: str, kind: str, block: str, text: dict[str, str], company: str, person: str = "commander") -> tuple[DataFrame, DataFrame]:
    """(distinct spellings, named by their least id; id and rep of every row): see ``link_variants``."""
    spelling = F.coalesce(*[F.when(F.col(kind) == k, F.col(c)) for k, c in text.items()])
    rows = names.select(F.col(key).cast("bigint").alias("id"), F.col(kind).alias("kind"), F.concat_ws("|", kind, block).alias("block"), spelling.alias("text"), F.col(company).alias("company"), F.col(block).alias("_b")).where(
        "id is not null and kind is not null and _b is not null and text <> ''"
    )
    tokens = durable(rows.select("id", "kind", "block", "text", "company").mapInArrow(_tokenised(kind, person), _TOKENS))
    form = ["block", "code", "tag", "tokens"]
    one = tokens.groupBy(*form).agg(F.min("id").alias("rep"), F.max("company").alias("company"))
    one = durable(one.select(F.col("rep").alias("id"), "block", "company", "code", "tag", "tokens"))
    copies = tokens.join(one.select(*form, F.col("id").alias("rep")), form).select("id", "rep")
    return one, copies


def link_variants(names: DataFrame, key: str, kind: str, block: str, text: dict[str, str], company: str, person: str = "commander") -> DataFrame:
    """``(id, group_id)``: the group of spellings each row of ``names`` belongs to, named by its least id.

    ``text`` gives for each value of ``kind`` the column with the spelling;
    rows of kind ``person`` are persons' names, others labels of groups with an
    optional tag.  Only rows of one kind and ``block`` can belong together.
    Rows with a null kind, block or spelling, and empty spellings, stay alone.
    Default names belong together only with the same code.  Rows with the same
    spelling are joined as copies, not as pairs.
    """
    one, copies = spellings(names, key, kind, block, text, company, person)
    fuzzy = one.where("code = ''")
    known = durable(described(fuzzy))
    pairs = candidate_pairs(known, person)
    known = known.select("id", "company", "tag", "tokens", "counts", "total")
    side = lambda s: known.select(*[F.col(c).alias(f"{c}_{s}") for c in known.columns])
    links = durable(pairs.join(side("a"), "id_a").join(side("b"), "id_b").mapInArrow(_judged, "a bigint, b bigint, likeness double, hint boolean, company int"))
    strong = components_of(links.where("not hint"))
    of = lambda name, to: strong.select(F.col("node").alias(name), F.col("component").alias(to))
    hints = links.where("hint").join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"), "company").where("ca <> cb")
    hints = durable(hints.distinct())
    # A full form is one that hints at no other; others count as targets only where no full form is in reach.
    full = hints.join(hints.select(F.col("ca").alias("cb")).distinct().withColumn("_h", F.lit(1)), "cb", "left").withColumn("_f", F.col("_h").isNull())
    full = full.withColumn("_any", F.max("_f").over(Window.partitionBy("ca"))).where("_f or not _any")
    target = full.groupBy("ca").agg(F.min("cb").alias("lo"), F.max("cb").alias("hi"), F.min(F.when(F.col("company") == 1, F.col("cb"))).alias("same_lo"), F.max(F.when(F.col("company") == 1, F.col("cb"))).alias("same_hi"))
    chosen = target.select(F.col("ca").alias("a"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("same_lo") == F.col("same_hi"), F.col("same_lo")).alias("b")).where("b is not null")
    merged = components_of(chosen).select(F.col("node").alias("component"), F.col("component").alias("top"))
    first = copies.join(strong.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    return first.join(merged, "component", "left").select("id", F.coalesce("top", "component").alias("group_id"))


def described(fuzzy: DataFrame) -> DataFrame:
    """Spellings (id, block, company, tag, tokens) with ``counts`` of their tokens over the whole corpus of their kind, its
    ``total``, ``forms``: each token with its more frequent neighbours, and ``short``: whether one of them may be a short form.
    """
    spread = fuzzy.select("id", F.split("block", "[|]")[0].alias("kind"), F.posexplode("tokens").alias("pos", "token"))
    total = fuzzy.groupBy(F.split("block", "[|]")[0].alias("kind")).agg(F.count("*").alias("total"))
    vocabulary = durable(spread.groupBy("kind", "token").agg(F.countDistinct("id").alias("n")).join(F.broadcast(total), "kind"))
    near = neighbours(vocabulary)
    # What begins a longer word by two letters or more may be a cut-off, and so may a rare word; an initial always is one.
    begins = vocabulary.where("length(token) > 3").select("kind", F.explode(F.transform(F.sequence(F.lit(2), F.length("token") - 2), lambda n: F.substring("token", F.lit(1), n))).alias("token")).distinct().withColumn("begins", F.lit(True))
    rare = F.col("n") - 1.64 * F.sqrt("n") <= RARE * F.col("total")
    common = near.groupBy("kind", "token").agg(F.sort_array(F.collect_set("common")).alias("common"))
    words = vocabulary.join(begins, ["kind", "token"], "left").join(common, ["kind", "token"], "left")
    nothing = F.array().cast("array<string>")
    words = words.select("kind", "token", "n", "total", F.concat(F.array("token"), F.coalesce("common", nothing)).alias("forms"), (rare | F.coalesce("begins", F.lit(False)) | (F.length("token") <= 3)).alias("short"))
    each = F.sort_array(F.collect_list(F.struct("pos", "n", "forms", "short", "total")))
    told = spread.join(words, ["kind", "token"]).groupBy("id").agg(each.alias("_w"))
    return fuzzy.join(told, "id", "left").select(
        "id", "block", "company", "tag", "tokens", F.coalesce("_w.n", F.array().cast("array<bigint>")).alias("counts"), F.coalesce("_w.forms", F.array().cast("array<array<string>>")).alias("forms"),
        F.coalesce(F.array_max("_w.total"), F.lit(0)).cast("bigint").alias("total"), F.exists(F.coalesce("_w.short", F.array().cast("array<boolean>")), lambda x: x).alias("short"),
    )


def components_of(edges: DataFrame) -> DataFrame:
    return connected_components(edges.select("a", "b"))


def group_pairs(groups: DataFrame) -> DataFrame:
    """Every pair ``(id_a, id_b)`` of rows of one group, id_a < id_b; groups are the spellings of one name."""
    size = groups.withColumn("n", F.count("*").over(Window.partitionBy("group_id"))).where("n > 1")
    return size.alias("x").join(size.alias("y"), (F.col("x.group_id") == F.col("y.group_id")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
