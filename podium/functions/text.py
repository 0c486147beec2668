"""Keys and cleaned forms of names and labels.

Everything that Spark has a function for is a plain column expression; only
Unicode normalisation and full case folding, which it lacks, run as Arrow
pandas UDFs, once per distinct value of a batch.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What a player without an alliance is shown with, fixed value.
NO_ALLIANCE = "No Alliance"
#: What stands for a name that could not be read, fixed value.
UNREADABLE = "(name unreadable by OCR)"
# Characters taken for one another, after case folding, for look-alike keys of names.
CONFUSABLE_FROM = "01i|авсенкмортухіјѕ"
CONFUSABLE_TO = "olllabcehkmoptyxljs"
# Characters taken for one another in labels.
LABEL_FROM, LABEL_TO = "0O1Ii|!", "oolllll"
#: Characters as which a closing bracket is misread, fixed value.
FUSED = "UIJ1ulij|"


# Labels known to be misread, and what they stand for.
LABEL_FIXES = {
    "[P1MP] JU1CER": "[P1MP] JU1CE",
    "[P1MP]JU1CER": "[P1MP] JU1CE",
    "[P1MP]JU1CE": "[P1MP] JU1CE",
    "[7DS] Se7enDeàdlySinsR": "[7DS] Se7enDeàdlySins",
    "[cHIL] ChillEmpire": "[CHIL] ChillEmpire",
    "[CLAVI ВОЙНЫ": "[CLAV] ВОЙНЫ",
    "[CLAV] ВОЙНЫ-": "[CLAV] ВОЙНЫ",
    "[FBLL] DVDVDVD": "[FBL3] DVDVDVDC",
    "[HElI] DarkAl": "[HEII] DarkAl",
    "[Hhhh] Xpovoç": "[Hhhh] Xpovos",
    "[QCKJ QUICKREACTIONFORCE": "[QCK] QUICKREACTIONFORCE",
    "[RTRJ RETRO": "[RTR] RETRO",
    "TSKG] Horizon": "[SKG] Horizon",
    "UJQK] JQKKK": "[JQK] JQKKK",
    "UQK]JOKKK": "[JQK] JQKKK",
    "[19o] CandyClub": "[190] CandyClub",
    "[1BİR] XOXOX": "[1BiR] XOXOX",
    "[TІOX] ПоХуисты": "[TIOX] ПоХуисты",
    "Df] 아무이름이나붙이기": "[Df] 아무이름이나붙이기",
    "[OBS] ZeroBullsht": "[0BS] ZeroBullsht",
    "[Geujl hehrb": "[Geuj] hehrb",
    "[|HA] USAL]": "[IHA] USALJ",
    "[|HA] USALJ": "[IHA] USALJ",
    "[IHA] USAL)": "[IHA] USALJ",
    "Usib] aksjf": "[Jsib] aksjf",
    "[sib] aksjf": "[Jsib] aksjf",
    "ICCCC] CCCCCCCCCCCCCCCCCCCC": "[CCCC] CCCCCCCCCCCCCCCCCCCC",
    "USMF] forte": "[USMF] forte",
    "[zZZ] Zombiz": "[zZZ] ZombiZ",
}


def _each(values: pd.Series, function) -> pd.Series:
    made = {v: function(v) for v in values.dropna().unique()}
    return pd.Series([made.get(v) if isinstance(v, str) else None for v in values], index=values.index, dtype=object)


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Compatibility normalisation in composed form."""
    return _each(values, lambda v: unicodedata.normalize("NFKC", v))


@F.pandas_udf(StringType())
def nfkc_fold(values: pd.Series) -> pd.Series:
    """Compatibility normalisation, then full case folding."""
    return _each(values, lambda v: unicodedata.normalize("NFKC", v).casefold())


@F.pandas_udf(StringType())
def casefold(values: pd.Series) -> pd.Series:
    """Full case folding."""
    return _each(values, str.casefold)


@F.pandas_udf(StringType())
def _name_core(values: pd.Series) -> pd.Series:
    return _each(values, lambda v: "".join(c for c in unicodedata.normalize("NFKC", v) if c.isalnum()).casefold())


def name_key(name: Column) -> Column:
    """Identity of a name: normalised, only letters and digits, case folded.  Null and symbols only give ''."""
    return F.coalesce(_name_core(name), F.lit(""))


def confusable_key(name: Column) -> Column:
    """Look-alike key of a name; folded before look-alikes are mapped.  Null gives ''."""
    return F.coalesce(F.regexp_replace(F.translate(nfkc_fold(name), CONFUSABLE_FROM, CONFUSABLE_TO), r"[^\p{L}\p{N}]", ""), F.lit(""))


def label_key(label: Column) -> Column:
    """Look-alike key of an alliance label: without spaces and brackets, look-alikes mapped, small letters."""
    return F.lower(F.translate(F.regexp_replace(label, r"(?U)[\s\[\]()]", ""), LABEL_FROM, LABEL_TO))


def stripped(text: Column) -> Column:
    """``text`` without white space at its ends, Unicode's included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def label_tag(label: Column) -> Column:
    """The tag of "[TAG] Name" without its spaces; '' if there is none."""
    return F.coalesce(F.regexp_replace(F.regexp_extract(stripped(label), r"(?Us)^\[(.*?)\]\s*(.*)$", 1), r"(?U)\s", ""), F.lit(""))


def label_name(label: Column) -> Column:
    """The name of "[TAG] Name"; the whole label if it has no tag, the no-alliance label if empty or null."""
    text = stripped(F.coalesce(label, F.lit("")))
    name = F.when(text.rlike(r"(?Us)^\[(.*?)\]\s*(.*)$"), stripped(F.regexp_extract(text, r"(?Us)^\[(.*?)\]\s*(.*)$", 2))).otherwise(text)
    return F.when(text == "", F.lit(NO_ALLIANCE)).otherwise(name)


def brackets(label: Column) -> Column:
    """``label`` with full-width square brackets as plain ones."""
    return F.translate(label, "［］", "[]")


def display(tag: Column, name: Column) -> Column:
    """"[TAG] Name", or the name alone without a tag."""
    return F.when(tag != "", stripped(F.concat(F.lit("["), tag, F.lit("] "), name))).otherwise(name)


def normal_label(label: Column) -> Column:
    """A label in its display form: plain brackets, tag without spaces, one space before the name."""
    text = brackets(F.coalesce(label, F.lit(NO_ALLIANCE)))
    return display(label_tag(text), label_name(text))


def server_code(explicit: Column, label: Column, home: str) -> Column:
    """The server of a player: as given without a leading S, else from the end of the label, else home."""
    given = F.regexp_replace(stripped(explicit.cast("string")), "^[Ss]", "")
    ending = F.regexp_extract(stripped(label), r"(?U)\bS(\d{2,4})\s*$", 1)
    return F.when(given != "", given).when(ending != "", ending).otherwise(F.lit(home))


def without_server(label: Column) -> Column:
    """``label`` without a server written at its end."""
    return stripped(F.regexp_replace(label, r"(?U)\s*S\d+\s*$", ""))


def tag_confusable(a: Column, b: Column, key_a: Column, key_b: Column, fused_keys_a: Column, fused_keys_b: Column) -> Column:
    """Whether two tags may be readings of one: as long with at most one different letter and equal keys, or one
    longer by a character that may be a bracket, without which the keys are equal.

    ``fused_keys_x`` are the keys of x without one such character (see ``fused_forms``).
    """
    low_a, low_b = F.lower(a), F.lower(b)
    differ = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), F.lit(0), lambda n, i: n + F.when(F.substring(low_a, i, F.lit(1)) != F.substring(low_b, i, F.lit(1)), 1).otherwise(0))
    same = (F.length(a) == F.length(b)) & (differ <= 1) & (key_a == key_b)
    longer_a = (F.length(a) == F.length(b) + 1) & F.array_contains(fused_keys_a, key_b)
    longer_b = (F.length(b) == F.length(a) + 1) & F.array_contains(fused_keys_b, key_a)
    return same | longer_a | longer_b


@F.pandas_udf(StringType())
def _fused(values: pd.Series) -> pd.Series:
    def forms(tag: str) -> str:
        out = []
        for i, c in enumerate(tag):
            if c in FUSED:
                text = unicodedata.normalize("NFKC", tag[:i] + tag[i + 1 :]).casefold().translate(str.maketrans(CONFUSABLE_FROM, CONFUSABLE_TO))
                out.append("".join(x for x in text if x.isalnum()))
        return "\x1f".join(dict.fromkeys(out))

    return _each(values, forms)


def fused_forms(tag: Column) -> Column:
    """Look-alike keys of ``tag`` without one character as which a bracket may be misread."""
    return F.split(F.coalesce(_fused(tag), F.lit("")), "\x1f")
