"""Problem 8: text decoded with the wrong character encoding.

A noisy channel: someone wrote a clean word, it was encoded as Y, read as X,
and some bytes may have been lost.  For every run of letters and non-ASCII
characters the bytes under each X are laid out as a lattice in which a lost
byte (a replacement mark, a question mark inside a word, a byte that X cannot
show) is a wildcard; a Viterbi search over that lattice, scored by letter
bigrams of the corpus, gives the likeliest clean spellings, and word
frequencies of the corpus decide between them and the run as it stands.

Two passes, no shuffle of texts.  The first counts in how many documents each
run occurs, combined per batch and before the shuffle, over all documents.
Runs found in at least a fixed share of documents form the model: there can be
no more of them than the mean number of distinct runs in a document divided by
that share, whatever the size of the corpus, so the model can be sent to every
worker.  The second pass judges each distinct run once per worker and each
document by its runs.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of documents from which a run belongs to the model, and the least number of documents.
SHARE, LEAST = 2e-4, 2
#: Most runs the model may have; beyond it the bound above is broken and the operator stops.
MAX_MODEL = 400_000
#: A clean spelling must be found in so many times the documents that hold the run as it stands.
RATIO_UTF8, RATIO_BYTE = 1.5, 4.0
# Encodings in which the bytes of UTF-8 are misread, and pairs (read as, written in) of one-byte encodings.
MISREAD_UTF8 = ["cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "cp866", "koi8_r", "iso8859_2", "gbk"]
MISREAD_BYTE = [
    ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1252", "cp866"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"),
    ("cp1251", "cp866"), ("cp866", "cp1251"), ("koi8_r", "cp866"), ("cp866", "koi8_r"), ("cp1252", "cp1250"),
    ("cp1252", "iso8859_2"), ("cp1251", "cp1250"), ("cp1250", "cp1251"), ("cp1250", "cp1252"), ("cp1251", "cp1252"),
    ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp852", "cp1252"), ("cp852", "cp1250"), ("cp850", "cp1250"),
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "cp852"), ("cp1250", "cp852"), ("mac_roman", "cp1252"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1251"), ("cp866", "cp1252"), ("koi8_r", "cp1252"), ("iso8859_5", "cp1251"),
    ("cp1251", "iso8859_5"), ("cp1252", "iso8859_5"), ("cp1250", "iso8859_2"), ("iso8859_2", "cp1250"), ("mac_cyrillic", "cp1251"),
    ("cp1251", "mac_cyrillic"), ("cp437", "cp1251"), ("cp850", "cp1251"), ("cp437", "cp1250"), ("gbk", "cp1251"), ("gbk", "cp1252"),
]
LOST = "�"
_RUN = regex.compile(r"[A-Za-z]*(?:[^\x00-\x7f][A-Za-z]*)+")
_MARK = regex.compile(r"[A-Za-z?\u0080-\U0010ffff]*\?[A-Za-z?\u0080-\U0010ffff]*")
_C1 = regex.compile(r"[\x80-\x9f]")
_LOST_SIGN = regex.compile(r"(?<![^\s(\[\"])\?+(?= ?\p{L}|[ ]?\d)|(?<=\d )\?(?=[\s.,;)])|(?<=\p{L})\?+(?=\p{L})|\?{2,}")
#: Addresses, in which a question mark is no lost sign.
_ADDRESS = regex.compile(r"\S*(?:://|www\.|\w\.\p{Ll}{2,6}/)\S*\?\S*|\S*\?[\w.%-]+=\S*")
_LETTER = regex.compile(r"\p{L}")
_FOREIGN = {
    "Latin": regex.compile(r"\p{Latin}"),
    "Cyrillic": regex.compile(r"\p{Cyrillic}"),
    "Greek": regex.compile(r"\p{Greek}"),
    "Han": regex.compile(r"\p{Han}"),
}


def _bytes_of(codec: str) -> dict[str, bytes]:
    table: dict[str, bytes] = {}
    for b in range(0x80, 0x100):
        try:
            table[bytes([b]).decode(codec)] = bytes([b])
        except UnicodeDecodeError:
            pass
    if codec in ("cp1252", "cp1250", "cp1251"):  # what these cannot show is often passed through
        for b in range(0x80, 0xA0):
            table.setdefault(chr(b), bytes([b]))
    return table


_TO_BYTES = {c: _bytes_of(c) for c in {*MISREAD_UTF8, *(x for x, _ in MISREAD_BYTE)} if c != "gbk"}


def _translate(x: str, y: str) -> dict[int, str]:
    out: dict[int, str] = {}
    for char, raw in _TO_BYTES[x].items():
        try:
            out[ord(char)] = raw.decode(y)
        except UnicodeDecodeError:
            out[ord(char)] = ""
    return out


_TABLES = {(x, y): _translate(x, y) for x, y in MISREAD_BYTE if x != "gbk"}


def raw_bytes(run: str, codec: str) -> list[int | None] | None:
    """The bytes of ``run`` as read in ``codec``, None for a lost one; None if it can't have been read so."""
    if codec == "gbk":
        out: list[int | None] = []
        for c in run:
            if c == LOST:
                out.append(None)
                continue
            try:
                out += c.encode("gbk")
            except UnicodeEncodeError:
                return None
        return out
    table = _TO_BYTES[codec]
    out = []
    for c in run:
        if c < "\x80" and c != "?":
            out.append(ord(c))
        elif c in (LOST, "?"):
            out.append(None)
        elif c in table:
            out += table[c]
        else:
            return None
    return out


def strict(raw: list[int | None]) -> str | None:
    """``raw`` as UTF-8 if no byte is lost and all sequences are whole."""
    if None in raw:
        return None
    try:
        return bytes(raw).decode("utf-8")
    except UnicodeDecodeError:
        return None


class Model:
    """Runs that are common in the corpus, and the letters and bigrams of which they consist."""

    def __init__(self, counts: dict[str, int], documents: int) -> None:
        self.counts = counts
        self.documents = max(documents, 1)
        chars: Counter[str] = Counter()
        pairs: Counter[tuple[str, str]] = Counter()
        for run, n in counts.items():
            text = f" {run} "
            for a, b in zip(text, text[1:]):
                pairs[a, b] += n
                chars[a] += n
        total = sum(chars.values()) or 1
        self.char = {c: math.log(n / total) for c, n in chars.items()}
        self.pair = {p: math.log(n / chars[p[0]]) for p, n in pairs.items()}
        self.floor = math.log(0.5 / total)
        self.by_lead: dict[int, list[tuple[bytes, str]]] = defaultdict(list)
        for c in chars:
            if c > "\x7f" and c != LOST:
                raw = c.encode("utf-8", "replace")
                self.by_lead[raw[0]].append((raw, c))
        self.every = [x for group in self.by_lead.values() for x in group]
        self.masked: dict[str, tuple[str, int]] = {}
        for run, n in counts.items():
            if any(c in run for c in (LOST, "?")):
                continue
            for mask in {"".join(c if c < "\x80" else "?" for c in run), "".join(c if c < "\x80" else "?" * len(c.encode("utf-8", "replace")) for c in run)}:
                if n > self.masked.get(mask, ("", 0))[1]:
                    self.masked[mask] = (run, n)
        self.judged: dict[str, tuple[str, str, float]] = {}

    def step(self, before: str, after: str) -> float:
        return self.pair.get((before, after)) or self.char.get(after, self.floor) - 3.0

    def likelihood(self, text: str) -> float:
        padded = f" {text} "
        return sum(self.step(a, b) for a, b in zip(padded, padded[1:]))

    def decode(self, raw: list[int | None], width: int = 6) -> list[str]:
        """Likeliest readings as UTF-8 of bytes with wildcards: Viterbi search keeping ``width`` paths a position."""
        beams: list[list[tuple[float, str, int]]] = [[] for _ in range(len(raw) + 1)]
        beams[0] = [(0.0, "", 0)]
        for at in range(len(raw)):
            if not beams[at]:
                continue
            paths = sorted(beams[at], reverse=True)[:width]
            b = raw[at]
            options: list[tuple[str, int, int]] = []
            if b is not None and b < 0x80:
                options.append((chr(b), 1, 0))
            elif b is None or b >= 0xC2:
                for code, c in self.every if b is None else self.by_lead.get(b, ()):
                    size = len(code)
                    window = raw[at : at + size]
                    if len(window) == size and all(w is None or w == x for w, x in zip(window, code)):
                        options.append((c, size, sum(w is None for w in window)))
                    elif size > 2 and b is not None and window[: size - 1] == list(code[: size - 1]) and (len(window) < size or not 0x80 <= (window[-1] or 0) < 0xC0):
                        options.append((c, size - 1, 1))  # the last byte was dropped
                    elif size == 2 and b is not None and (len(window) < 2 or (window[-1] is not None and not 0x80 <= window[-1] < 0xC0)) and code[1] in (0x80, 0x81, 0x8D, 0x8F, 0x90, 0x9D, 0xA0, 0xAD):
                        options.append((c, 1, 1))
            for score, text, lost in paths:
                for c, size, gone in options:
                    beams[at + size].append((score + self.step(text[-1:] or " ", c) - 2.0 * gone, text + c, lost + gone))
        return [text for _, text, _ in sorted(beams[-1], reverse=True)[:width]]

    def spellings(self, run: str) -> Iterator[tuple[str, str, bool]]:
        """(channel, clean spelling, whether all its bytes are there) for every way ``run`` may have been misread."""
        wild = LOST in run or "?" in run
        for codec in MISREAD_UTF8:
            raw = raw_bytes(run, codec)
            if raw is None or not any(b is not None and b >= 0xC2 for b in raw):
                continue
            exact = strict(raw)
            for text in dict.fromkeys([*([exact] if exact else []), *self.decode(raw)]):
                if text == run:
                    continue
                yield f"utf-8 as {codec}", text, text == exact
                again = raw_bytes(text, "cp1252")
                if again and any(b is not None and b >= 0xC2 for b in again):
                    deep = strict(again)
                    for deeper in dict.fromkeys([*([deep] if deep else []), *self.decode(again, 3)]):
                        if deeper != text:
                            yield f"utf-8 as {codec} twice", deeper, deeper == deep and text == exact
        if wild:
            mask = run.replace(LOST, "?")
            if mask in self.masked:
                yield "lost", self.masked[mask][0], False
            return
        for x, y in MISREAD_BYTE:
            if x == "gbk":
                try:
                    text = run.encode("gbk").decode(y)
                except UnicodeError:
                    continue
            else:
                table = _TABLES[x, y]
                if any(c > "\x7f" and ord(c) not in table for c in run):
                    continue
                text = run.translate(table)
            if text != run:
                yield f"{y} as {x}", text, True

    def judge(self, run: str) -> tuple[str, str, float]:
        """(channel or empty, clean spelling, weight of the evidence) of a run.

        The weight is the number of characters the evidence rests on: a run
        explained by one odd sign weighs 1, a whole word its length.
        """
        known = self.judged.get(run)
        if known is not None:
            return known
        here = self.counts.get(run, 0)
        best, best_score = ("", run, 0.0), 0.0
        own = self.likelihood(run)
        for channel, text, complete in self.spellings(run):
            there = self.counts.get(text, 0)
            utf8 = channel.startswith("utf-8")
            if channel == "lost":
                score, weight = 1.0 + math.log(there), float(run.count(LOST) + run.count("?"))
            elif there:
                if there < (RATIO_UTF8 if utf8 else RATIO_BYTE) * max(here, 1):
                    continue
                changed = sum(c > "\x7f" for c in run)
                score = math.log(there / max(here, 0.5)) + (6.0 if utf8 else 0.0)
                weight = max(2.0, float(changed)) if utf8 else float(min(len(text), changed + 1))
                if not utf8 and not here and there >= 0.01 * self.documents and not _LETTER.search(text):
                    weight = 3.0 if _LETTER.search(run) else 5.0  # a sign that is never seen reads as one that always is
                elif not utf8 and not _shape(run):
                    weight += 2.0
            elif utf8 and complete and here < LEAST + SHARE * self.documents * 4:
                gain = self.likelihood(text) - own
                if gain <= 2.0 or not _shape(text):
                    continue
                score, weight = 0.5 + gain / 100, 2.0
            else:
                continue
            if score > best_score:
                best, best_score = (channel, text, weight), score
        if len(self.judged) > 400_000:
            self.judged.clear()
        self.judged[run] = best
        return best

    def restore(self, text: str) -> tuple[bool, str, int]:
        """(whether any passage is garbled, text as far as restored, number of runs restored)."""
        marks = LOST in text or bool(_C1.search(text)) or lost_sign(text)
        found: Counter[str] = Counter()
        weight: Counter[str] = Counter()
        runs = set(_RUN.findall(text))
        change: dict[str, str] = {}
        unsure = []
        for run in runs:
            channel, clean, w = self.judge(run)
            if channel:
                found[channel] += 1
                weight[channel] += w
                change[run] = clean
            elif not self.counts.get(run):
                unsure.append(run)
        sure = {c for c in found if c.startswith("utf-8") and weight[c] >= 2 or c == "lost" or weight[c] >= 5}
        change = {run: clean for run, clean in change.items() if self.judge(run)[0] in sure}
        if sure:
            main = max(sure, key=lambda c: weight[c])
            for run in unsure:  # rarer words of a passage that went through the same channel
                for channel, clean, complete in self.spellings(run):
                    if channel == main and complete and self.likelihood(clean) > self.likelihood(run) + 2 and _shape(clean):
                        change[run] = clean
                        break
        if lost_sign(text):
            for run in set(_MARK.findall(text)):
                hit = self.masked.get(run.replace(LOST, "?"))
                if hit and (_LETTER.search(hit[0]) or len(run) > 1):
                    change[run] = hit[0]
        if not change:
            return marks, text, 0
        fixed = _RUN.sub(lambda m: change.get(m.group(), m.group()), text)
        if "?" in fixed:
            fixed = _MARK.sub(lambda m: change.get(m.group(), m.group()), fixed)
        return marks or bool(sure), fixed, len(change)


def lost_sign(text: str) -> bool:
    """Whether a question mark of ``text`` stands for a lost letter or sign; those of addresses don't."""
    return "?" in text and bool(_LOST_SIGN.search(text)) and bool(_LOST_SIGN.search(_ADDRESS.sub(" ", text)))


def _shape(text: str) -> bool:
    """Whether a word looks written: one script, no control or unassigned characters."""
    if any(unicodedata.category(c)[0] == "C" for c in text):
        return False
    return sum(bool(p.search(text)) for p in _FOREIGN.values()) <= 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(set(_RUN.findall(text)))
        if len(counts) > 200_000:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["run", "n"])
            counts.clear()
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["run", "n"])


def learn(documents: DataFrame, text: str, share: float = SHARE, least: int = LEAST) -> tuple[dict[str, int], int]:
    """Document counts of the runs common enough for the model, and the number of documents, over all of ``documents``."""
    texts = documents.select(F.col(text).alias("text")).where("text <> ''")
    n = texts.count()
    runs = texts.mapInArrow(_count, "run string, n bigint").groupBy("run").agg(F.sum("n").alias("n"))
    common = runs.where(F.col("n") >= max(least, share * n)).limit(MAX_MODEL + 1).collect()
    if len(common) > MAX_MODEL:
        raise ValueError(f"more than {MAX_MODEL} runs are common; raise the share from which a run is")
    return {r.run: r.n for r in common}, n


def restored(documents: DataFrame, key: str, text: str, share: float = SHARE, least: int = LEAST, with_text: bool = True) -> DataFrame:
    """The garbled rows of ``documents``: ``key``, and with ``with_text`` also ``restored`` and ``n_restored``.

    Null and empty texts are not garbled.  A text that can't be restored, or
    only in places, is returned with what could be restored.  Whole texts are
    read, whatever their length; other columns are ignored.
    """
    counts, n = learn(documents, text, share, least)
    shared = documents.sparkSession.sparkContext.broadcast((counts, n))
    rows = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text <> '' and (_text rlike '[^\\\\x00-\\\\x7f]' or instr(_text, '?') > 0)")
    key_type = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            got = [model.restore(t) for t in batch.column(1).to_pylist()]
            bad = pa.array([g[0] for g in got], pa.bool_())
            columns = [batch.column(0).filter(bad)]
            if with_text:
                columns += [pa.array([g[1] for g in got if g[0]], pa.string()), pa.array([g[2] for g in got if g[0]], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "restored", "n_restored"][: len(columns)])

    return rows.mapInArrow(run, f"{key} {key_type}" + (", restored string, n_restored bigint" if with_text else ""))
