"""The SQL's text functions against Python's, over every character of the blocks they cover."""

import unicodedata

import duckdb

from podium.plans import sqltext as q

WORDS = ["Ｗulfgar", "ﬁre Ǌ ⅣＸ", "Zoë Quinn", "ΛΕΥΚΌΣ ς", "Straße ẞ", "ДРАКОН", "a　b c", "1I|!0", "ŉ İ", ""]


def run(sql, values):
    con = duckdb.connect()
    con.execute("create table t (n int, x varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"select {sql} from t order by n").fetchall()]


def test_compatibility_forms_and_folding():
    chars = [f"x{chr(n)}y" for low, high in q.FORMS + q.FOLDS for n in range(low, high + 1) if unicodedata.category(chr(n)) != "Cn"]
    assert run(q.nfkc("x"), WORDS) == [unicodedata.normalize("NFKC", w) for w in WORDS]
    forms = [unicodedata.normalize("NFKC", w) for w in chars + WORDS]
    assert run(q.fold(q.nfkc("x")), chars + WORDS) == [w.casefold() for w in forms]
    keys = ["".join(c for c in unicodedata.normalize("NFKC", w) if c.isalnum()).casefold() for w in chars + WORDS]
    assert run(q.name_key("x"), chars + WORDS) == keys


def test_labels_and_edits():
    labels = ["  [A B] Long  Name ", "No tag", "[", "", None, "［ÜB］ Ünder", "[] x", "[T]\nName"]
    assert run(q.label_tag("x"), labels) == ["AB", "", "", "", "", "", "", "T"]
    assert run(q.label_name("x"), labels) == ["Long  Name", "No tag", "[", "No Alliance", "No Alliance", "［ÜB］ Ünder", "x", "Name"]
    assert run(q.normal_label("x"), labels)[5] == "[ÜB] Ünder"
    pairs = [("a🦊b", "ab", True), ("ab", "ba", False), ("abc", "abc", True), ("abc", "axc", True), ("", "a", True), ("ab", "abcd", False), ("öx", "ox", True)]
    con = duckdb.connect()
    for a, b, same in pairs:
        assert con.execute(f"select {q.one_edit('a', 'b')} from (select '{a}' as a, '{b}' as b)").fetchone()[0] is same, (a, b)
