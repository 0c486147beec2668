"""The text functions of ``functions/text.py`` as SQL for DuckDB, which lacks compatibility forms and full case folding.

Both are written as mappings made by a rule over the blocks of characters that
names are typed in; ``tests/test_sqltext.py`` compares them with Python's.
"""

from __future__ import annotations

import sys
import unicodedata

from podium.functions.text import CONFUSABLE_FROM, CONFUSABLE_TO, FUSED, LABEL_FROM, LABEL_TO

#: Blocks whose compatibility forms are undone: Latin and Greek signs, spaces and punctuation, numerals, ligatures, wide forms.
FORMS = [(0x00A0, 0x00BF), (0x0132, 0x01F5), (0x02B0, 0x03FF), (0x1E9A, 0x1FFF), (0x2000, 0x206F), (0x2100, 0x217F), (0x3000, 0x3000), (0xFB00, 0xFB06), (0xFF00, 0xFF5E)]
#: Blocks whose full case folding is not the small letter: Latin, Greek, Cyrillic and their extensions.
FOLDS = [(0x0041, 0x052F), (0x1E00, 0x1FFF)]
#: White space of both dialects, as a class of RE2.
SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_INNER = SPACE[1:-1]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _mapped(sql: str, pairs: dict[str, str]) -> str:
    """``sql`` with characters replaced: one to one in one go, the others one by one."""
    single = {a: b for a, b in pairs.items() if len(b) == 1}
    for a, b in pairs.items():
        if len(b) != 1:
            sql = f"replace({sql}, {_quoted(a)}, {_quoted(b)})"
    return f"translate({sql}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))})" if single else sql


def _over(blocks: list[tuple[int, int]], make) -> dict[str, str]:
    chars = [chr(n) for low, high in blocks for n in range(low, high + 1) if n <= sys.maxunicode]
    return {c: make(c) for c in chars if make(c) is not None}


_TO_FORMS = _over(FORMS, lambda c: f if (f := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c) else None)
# Of folded characters only those count that small letters don't give.
_TO_FOLDS = _over(FOLDS, lambda c: c.casefold() if unicodedata.normalize("NFKC", c) == c and (c.casefold() != c.lower() or len(c.lower()) > 1) else None)


def nfkc(x: str) -> str:
    return f"nfc_normalize({_mapped(x, _TO_FORMS)})"


def fold(x: str) -> str:
    return f"lower({_mapped(x, _TO_FOLDS)})"


def alnum(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}]', '', 'g')"


def name_key(x: str) -> str:
    return f"coalesce({fold(alnum(nfkc(x)))}, '')"


def confusable_key(x: str) -> str:
    looks = f"translate({fold(nfkc(x))}, {_quoted(CONFUSABLE_FROM)}, {_quoted(CONFUSABLE_TO)})"
    return f"coalesce({alnum(looks)}, '')"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


_LABEL = rf"(?s)^\[(.*?)\]{SPACE}*(.*)$"


def label_key(x: str) -> str:
    return f"lower(translate(regexp_replace({x}, '[{_INNER}\\[\\]()]', '', 'g'), {_quoted(LABEL_FROM)}, {_quoted(LABEL_TO)}))"


def label_tag(x: str) -> str:
    return f"coalesce(regexp_replace(regexp_extract({stripped(x)}, '{_LABEL}', 1), '{SPACE}', '', 'g'), '')"


def label_name(x: str) -> str:
    text = stripped(f"coalesce({x}, '')")
    return f"CASE WHEN {text} = '' THEN 'No Alliance' WHEN regexp_matches({text}, '{_LABEL}') THEN {stripped(f'''regexp_extract({text}, '{_LABEL}', 2)''')} ELSE {text} END"


def brackets(x: str) -> str:
    return f"translate({x}, '［］', '[]')"


def display(tag: str, name: str) -> str:
    return f"CASE WHEN {tag} <> '' THEN {stripped(f'''('[' || {tag} || '] ' || {name})''')} ELSE {name} END"


def normal_label(x: str) -> str:
    text = brackets(f"coalesce({x}, 'No Alliance')")
    return display(label_tag(text), label_name(text))


def without_server(x: str) -> str:
    return stripped(rf"regexp_replace({x}, '{SPACE}*S\p{{Nd}}+{SPACE}*$', '')")


def server_code(given: str, label: str, home: str) -> str:
    own = f"regexp_replace({stripped(given)}, '^[Ss]', '')"
    ending = rf"regexp_extract({stripped(label)}, '(?:^|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}])S(\p{{Nd}}{{2,4}}){SPACE}*$', 1)"
    return f"CASE WHEN {own} <> '' THEN {own} WHEN {ending} <> '' THEN {ending} ELSE '{home}' END"


def fused_forms(tag: str) -> str:
    """Look-alike keys of ``tag`` without one character as which a bracket may be misread, as a list."""
    cut = confusable_key(f"({tag}[:i - 1] || {tag}[i + 1:])")
    return f"list_transform(list_filter(range(1, length({tag}) + 1), lambda i: contains({_quoted(FUSED)}, {tag}[i])), lambda i: {cut})"


def tag_confusable(a: str, b: str, key_a: str, key_b: str, fused_a: str, fused_b: str) -> str:
    differ = f"length(list_filter(range(1, length({a}) + 1), lambda i: lower({a})[i] <> lower({b})[i]))"
    return f"""((length({a}) = length({b}) AND {differ} <= 1 AND {key_a} = {key_b})
      OR (length({a}) = length({b}) + 1 AND list_contains({fused_a}, {key_b})) OR (length({b}) = length({a}) + 1 AND list_contains({fused_b}, {key_a})))"""


def one_edit(a: str, b: str) -> str:
    """Whether two texts are at most one edit apart, counted in characters (DuckDB's levenshtein counts bytes)."""
    rest = f"({a}[i + 1:] = {b}[i + 1:] OR {a}[i:] = {b}[i + 1:] OR {a}[i + 1:] = {b}[i:])"
    return f"({a} = {b} OR (abs(length({a}) - length({b})) <= 1 AND len(list_filter(range(1, greatest(length({a}), length({b})) + 1), lambda i: {a}[:i - 1] = {b}[:i - 1] AND {rest})) > 0))"


def two_edits(a: str, b: str) -> str:
    """Whether two texts are at most two edits apart: beyond their common beginning the first edit is one of three."""
    same = f"len(list_filter(range(1, least(length({a}), length({b})) + 1), lambda p: {a}[:p] = {b}[:p]))"
    rest = [one_edit(f"({a}[{same} + {x}:])", f"({b}[{same} + {y}:])") for x, y in ((2, 2), (1, 2), (2, 1))]
    return f"({a} = {b} OR (abs(length({a}) - length({b})) <= 2 AND ({' OR '.join(rest)})))"
