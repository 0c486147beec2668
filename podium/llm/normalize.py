"""Problem 2: one consistent form for text that looks the same.

``plain`` keeps what a reader sees: compatibility normalisation in composed
form, every white space mapped to one ordinary space, default-ignorable
characters removed except inside emoji, and each word brought to one script.
``folded`` is the comparison key: the plain form under full case folding,
normalised again.  Both are computed once per distinct value of an Arrow batch
(dictionary encoding) and kept across batches of a worker, so repeated values
cost a lookup, there is no shuffle, and a hot value is no hot key.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters that look alike, by script, with their Latin look-alike.
CYRILLIC_LIKE = dict(zip("аеорсухіѕһјԁԛԝӏАВЕКМНОРСТХУҮІЅЈԚԜӀ", "aeopcyxishjdqwlABEKMHOPCTXYYISJQWI"))
GREEK_LIKE = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovABEZHIKMNOPTYX"))
#: Scripts told apart; East Asian ones are written together and count as one.
SCRIPTS = {
    "Latin": r"\p{Latin}",
    "Cyrillic": r"\p{Cyrillic}",
    "Greek": r"\p{Greek}",
    "Armenian": r"\p{Armenian}",
    "Georgian": r"\p{Georgian}",
    "Hebrew": r"\p{Hebrew}",
    "Arabic": r"\p{Arabic}",
    "Cherokee": r"\p{Cherokee}",
    "EastAsian": r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Bopomofo}]",
}
TO_LATIN = str.maketrans({**CYRILLIC_LIKE, **GREEK_LIKE})
_FROM_LATIN = {
    "Cyrillic": {v: k for k, v in reversed(CYRILLIC_LIKE.items())},
    "Greek": {v: k for k, v in reversed(GREEK_LIKE.items())},
}
_SCRIPT = {name: regex.compile(p) for name, p in SCRIPTS.items()}
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_IGNORABLE = regex.compile(r"\p{Default_Ignorable_Code_Point}+")
_SPACE = regex.compile(r"\s+")
_ONE = r"\p{Extended_Pictographic}(?:\p{Emoji_Modifier}|️)*(?:[\U000E0020-\U000E007E]+\U000E007F)?"
_EMOJI = regex.compile(rf"{_ONE}(?:‍{_ONE})*|[0-9#*]️?⃣")
_ASCII = regex.compile(r"[ -~]*")


@lru_cache(maxsize=65536)
def script_of(letter: str) -> str | None:
    """The script of a letter; None for letters common to several."""
    return next((name for name, p in _SCRIPT.items() if p.match(letter)), None)


def _visible(text: str) -> str:
    """``text`` without default-ignorable characters outside emoji."""
    if not _IGNORABLE.search(text):
        return text
    out, at = [], 0
    for m in _EMOJI.finditer(text):
        out += [_IGNORABLE.sub("", text[at : m.start()]), m.group()]
        at = m.end()
    return "".join(out) + _IGNORABLE.sub("", text[at:])


def _one_script(word: str) -> str:
    """``word`` with look-alike letters brought to the script of the others.

    The script that owns letters without a look-alike elsewhere wins, then the
    one with more letters; a letter with no look-alike there stays.
    """
    scripts = [script_of(c) for c in word]
    kinds = {s for s in scripts if s}
    if len(kinds) < 2:
        return word
    own = dict.fromkeys(kinds, 0)
    every = dict.fromkeys(kinds, 0)
    for c, s in zip(word, scripts):
        if s:
            every[s] += 1
            others = kinds - {s}
            if s == "Latin":
                own[s] += not any(c in _FROM_LATIN.get(o, {}) for o in others)
            else:
                own[s] += c.translate(TO_LATIN) == c
    best = max(kinds, key=lambda s: (own[s], every[s], s == "Latin"))
    if best == "Latin":
        return word.translate(TO_LATIN)
    back = _FROM_LATIN.get(best, {})
    return "".join(c if s in (best, None) else back.get(c.translate(TO_LATIN), c) for c, s in zip(word, scripts))


def plain(text: str | None) -> str | None:
    """The one form of what a reader sees in ``text``; null stays null."""
    if text is None or _ASCII.fullmatch(text) and "  " not in text and text == text.strip():
        return text
    out = unicodedata.normalize("NFKC", _visible(text))
    out = _SPACE.sub(" ", _visible(out)).strip()
    return unicodedata.normalize("NFKC", _WORD.sub(lambda m: _one_script(m.group()), out))


def folded(text: str | None) -> str | None:
    """The comparison key of ``text``: plain form, case folded, until neither changes it; null stays null.

    Folding can bring letters to a pair of look-alikes (V and nu), so the plain
    form is taken again.
    """
    if text is None:
        return None
    out = plain(text).casefold()
    for _ in range(4):
        again = plain(out).casefold()
        if again == out:
            break
        out = again
    return out


def skeleton(text: str) -> str:
    """``text`` in plain form with every look-alike letter as its Latin one: equal for texts that look the same."""
    return plain(text).translate(TO_LATIN)


def in_plain_form(text: str | None) -> bool:
    """Whether ``text`` is made of plain characters: composed, ordinary width, no merged letters, ordinary spaces, nothing invisible outside emoji, one script in each word.  Null and empty are."""
    if not text or _ASCII.fullmatch(text):
        return True
    if unicodedata.normalize("NFKC", text) != text:
        return False
    if _visible(text) != text:
        return False
    if any(c != " " for run in _SPACE.findall(text) for c in run):
        return False
    return all(len({s for c in m.group() if (s := script_of(c))}) < 2 for m in _WORD.finditer(text))


class Classifier:
    """Tells values that are not in plain form; with a reference list also those that look like an entry in letters of another script."""

    def __init__(self, reference: Iterable[str] = ()) -> None:
        self.reference = frozenset(reference)
        self.looks = frozenset(skeleton(x) for x in self.reference)
        self.kept: dict[str, bool] = {}

    def __call__(self, text: str | None) -> bool:
        if not text:
            return False
        known = self.kept.get(text)
        if known is None:
            if len(self.kept) > 500_000:
                self.kept.clear()
            known = self.kept[text] = not in_plain_form(text) or (skeleton(text) in self.looks and plain(text) not in self.reference)
        return known


def _mapped(function: Callable[[str | None], str | None], values: pa.Array) -> pa.Array:
    encoded = values.dictionary_encode()
    return pa.array([function(v) for v in encoded.dictionary.to_pylist()], pa.string()).take(encoded.indices)


def plain_column(column: Column) -> Column:
    """``plain`` as a column, once per distinct value of a batch."""
    return _plain_udf(column)


def folded_column(column: Column) -> Column:
    """``folded`` as a column, once per distinct value of a batch."""
    return _folded_udf(column)


@F.pandas_udf(StringType())
def _plain_udf(values: pd.Series) -> pd.Series:
    return _mapped(plain, pa.Array.from_pandas(values, type=pa.string())).to_pandas()


@F.pandas_udf(StringType())
def _folded_udf(values: pd.Series) -> pd.Series:
    return _mapped(folded, pa.Array.from_pandas(values, type=pa.string())).to_pandas()


def values_not_plain(df: DataFrame, key: str, fields: dict[str, list[str] | None]) -> DataFrame:
    """One row ``(key, field)`` for each value of ``fields`` that is not in plain form.

    ``fields`` maps a string column to a reference list, or None; a value with a
    list also counts if it looks like an entry but has letters of another
    script.  The list travels with the task, so its caller must bound it.  Null
    and empty values are plain; repeated rows are each reported; other columns
    are ignored.  ASCII values of fields without a list never leave the JVM.
    """
    names = list(fields)
    fields = {n: list(x) if x else None for n, x in fields.items()}
    kept = [F.when(F.col(n).rlike("[^ -~]") if fields[n] is None else F.col(n) != "", F.col(n)).alias(f"_f{i}") for i, n in enumerate(names)]
    rows = df.select(F.col(key).alias("_key"), *kept).where(" or ".join(f"_f{i} is not null" for i in range(len(names))))
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = [Classifier(fields[n] or ()) for n in names]
        for batch in batches:
            for i, name in enumerate(names):
                encoded = batch.column(i + 1).dictionary_encode()
                bad = pa.array([tests[i](v) for v in encoded.dictionary.to_pylist()], pa.bool_())
                keys = batch.column(0).filter(bad.take(encoded.indices))
                if len(keys):
                    yield pa.RecordBatch.from_arrays([keys, pa.array([name] * len(keys), pa.string())], names=[key, "field"])

    return rows.mapInArrow(run, f"{key} {key_type}, field string")


def normal_forms(df: DataFrame, fields: list[str]) -> DataFrame:
    """Each distinct value of ``fields`` with its forms: ``field, value, plain, folded, n_rows``.

    Counting distinct values aggregates before the shuffle, so a hot value is
    one row per task by then.  Nulls have no form and are left out.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in fields])).alias("_x")).select("_x.*").where(F.col("value").isNotNull())
    counted = pairs.groupBy("field", "value").agg(F.count("*").alias("n_rows"))
    return counted.select("field", "value", plain_column(F.col("value")).alias("plain"), folded_column(F.col("value")).alias("folded"), "n_rows")
