"""Text cleaning as Column expressions (no Python in the path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and signs that stand for a missing text.
MISSING_WORDS = ("", "nan", "none", "null", "nat", "na", "n/a", "n.a.", "n.a", "<na>", "unknown", "unk", "missing", "not available", "not known", "undefined", "-", "--", "---", "?", "??", ".", "...", "_", "x", "-9999", "-999", "#n/a")

# Accented letters and their plain forms.
ACCENTED = "áàâäãåāăąçćčďèéêëēėęěğìíîïīįłľñńňòóôöõøōőřśšşťùúûüūůűųýÿžźż"
PLAIN = "aaaaaaaaacccdeeeeeeeegiiiiiillnnnoooooooorssstuuuuuuuuyyzzz"

# White space as Python's strip knows it, which SQL's trim does not cover.
_EDGE = r"^[\s   -​    　﻿]+|[\s   -​    　﻿]+$"


def strip(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, _EDGE, "")


def clean_text(c: Column | str, limit: int | None = None) -> Column:
    """Trimmed text; null where it is null, blank or a word or sign for missing."""
    t = strip(c)
    t = F.when(F.lower(t).isin(*MISSING_WORDS), None).otherwise(t)
    return F.substring(t, 1, limit) if limit else t


def key_text(c: Column | str) -> Column:
    """Trimmed lower-case key."""
    return F.lower(strip(c))


def fold_accents(c: Column) -> Column:
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def normal_name(c: Column | str) -> Column:
    """Lower case without accents and punctuation, single spaces."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(fold_accents(c), r"[^\p{L}\p{N}]+", " "))


def canonical_uid(uid: Column, number: Column | None = None, prefix: str = "SED", width: int = 6) -> Column:
    """prefix + zero-padded number, from a badly written uid or, where it has no digits, from the number."""
    n = cluster_number(uid, number, prefix)
    t = n.cast("string")
    return F.when(n.isNull(), None).otherwise(F.concat(F.lit(prefix), F.when(F.length(t) < width, F.lpad(t, width, "0")).otherwise(t)))


def cluster_number(uid: Column, number: Column | None = None, prefix: str = "SED") -> Column:
    """The number behind a cluster key: the numeric column first, else the digits of the uid."""
    d = F.regexp_extract(F.upper(strip(uid)), rf"^(?:{prefix})?[\s_:#-]*0*(\d{{1,18}})$", 1)
    from_uid = F.when(d == "", None).otherwise(d).cast("bigint")
    if number is None:
        return from_uid
    ok = number.isNotNull() & (number >= 0)
    return F.coalesce(F.when(ok, number.cast("bigint")), from_uid)


def strip_marks(c: Column) -> Column:
    """Text without accents by Unicode decomposition (NFKD) and case folding, in Arrow batches; null stays null.

    :func:`fold_accents` does the same for common letters without leaving the JVM; this is for all of Unicode.
    """
    import unicodedata

    import pandas as pd

    def plain(t: str) -> str:
        return "".join(x for x in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(x))

    def work(s):
        return s.map(plain, na_action="ignore")

    work.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, "string")(c)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratio 0..1 of matching blocks of two texts (longest first), in Arrow batches; null where one is null, 1 for two empty texts."""
    from difflib import SequenceMatcher

    import pandas as pd

    def work(x, y):
        return pd.Series([None if p is None or q is None else SequenceMatcher(None, p, q, autojunk=False).ratio() for p, q in zip(x, y)], dtype="float64")

    work.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, "double")(a, b)
