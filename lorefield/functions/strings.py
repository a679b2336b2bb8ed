"""Text helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# The white space that Python's str.strip() and str.split() know, as a
# Java character class (needs the (?U) flag) and as characters.
WHITESPACE = r"[\s\x1c-\x1f]"
SPACE_CHARACTERS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def plain_text(df: DataFrame, name: str) -> Column:
    """A column as text the way Python writes it: ``True``, ``12345678.0``, ``1e-05``.

    Spark would write ``true``, ``1.2345678E7`` and ``1.0E-5``.
    """
    col = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    text = col.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.when(col.isNotNull(), F.initcap(text))
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return text
    form = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    part = lambda i: F.regexp_extract(text, form, i)
    power = part(4).try_cast("int")
    digits = F.concat(part(2), F.regexp_replace(part(3), r"^0$", ""))
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    rest = F.coalesce(F.nullif(F.substring(digits, power + 2, F.lit(40)), F.lit("")), F.lit("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    mantissa = F.regexp_replace(F.concat(part(2), F.lit("."), part(3)), r"\.0$", "")
    sign = F.when(power < 0, F.lit("-")).otherwise(F.lit("+"))
    raised = F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), F.greatest(
        F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return (F.when(power.isNull(), text)
            .when(power.between(0, 15), F.concat(part(1), whole, F.lit("."), rest))
            .when(power.between(-4, -1), F.concat(part(1), small))
            .otherwise(F.concat(part(1), raised)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often ``use`` mentions it.

    Not for arguments of a Python UDF: Spark does not find the UDF around it.
    """
    return F.try_element_at(F.transform(F.array(value), use), F.lit(1))


def strip(col: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(as_column(col), F.lit(SPACE_CHARACTERS))


def stem(file_name: Column | str) -> Column:
    """File name without folders and without its last extension."""
    base = F.regexp_replace(as_column(file_name), r"^.*/", "")
    return F.regexp_replace(base, r"(?s)(?<=[^.])\.[^.]*\z", "")


def unescape_text(col: Column | str) -> Column:
    r"""Turn the literal two-character sequences ``\n \r \t \" \'`` into characters."""
    out = as_column(col)
    for literal, char in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'), ("\\'", "'")):
        out = F.replace(out, F.lit(literal), F.lit(char))
    return out


def collapse_markdown_runs(col: Column | str) -> Column:
    """Shorten over-long runs of ``*``, ``-`` and ``=``."""
    out = as_column(col)
    for run, pattern, short in (("***", r"\*{3,}", "**"), ("----", r"-{4,}", "---"), ("====", r"={4,}", "===")):
        # Texts without a long run, most of them, are not rewritten.
        out = F.when(out.contains(run), F.regexp_replace(out, pattern, short)).otherwise(out)
    return out


def strip_bom(col: Column | str) -> Column:
    return F.regexp_replace(as_column(col), "^﻿", "")


def content_checksum(col: Column | str) -> Column:
    """MD5 hex digest of binary content or of a text's UTF-8 bytes."""
    return F.md5(as_column(col))


def token_count(col: Column | str) -> Column:
    """Number of words separated by white space."""
    text = strip(col)
    words = F.size(F.split(text, rf"(?U){WHITESPACE}+"))
    return F.when(text == "", F.lit(0)).otherwise(words)


# Words that mark a text as a query.
QUERY_WORDS = ("what", "how", "where", "when", "why", "who", "find", "search", "query")


def is_query(col: Column | str) -> Column:
    """Ends with ``?`` or contains one of the query words (as a substring)."""
    text = as_column(col)
    return strip(text).endswith("?") | F.lower(text).rlike("|".join(QUERY_WORDS))


def display_name(col: Column | str) -> Column:
    return F.initcap(F.replace(as_column(col), F.lit("_"), F.lit(" ")))


def safe_name(col: Column | str) -> Column:
    """Keep letters, digits, blanks, ``-`` and ``_``; drop trailing white space."""
    kept = F.regexp_replace(as_column(col), r"[^\p{L}\p{N} _-]", "")
    return F.regexp_replace(kept, r"\s+$", "")


def model_abbreviation(col: Column | str) -> Column:
    """Short ``letters-digits`` form of a model name, ``emb`` when it has neither."""
    name = as_column(col)
    letters = F.regexp_extract(F.regexp_extract(name, r"(?s)([^/]*)\z", 1), r"([a-zA-Z]{1,3})", 1)
    digits = F.right(F.regexp_extract(name, r"(?s)([\d.]*\d)[^\d]*\z", 1), F.lit(3))
    short = F.concat_ws("-", F.nullif(letters, F.lit("")), F.nullif(digits, F.lit("")))
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("emb"))


def parse_model_id(col: Column | str) -> Column:
    """``provider,model`` or ``provider/model`` as a struct; anything else fails."""
    text = as_column(col)
    parts = F.when(text.contains(","), F.split(text, ",", 2)).when(text.contains("/"), F.split(text, "/", 2))
    broken = F.raise_error(F.concat(F.lit("not a model identifier: "), text)).cast("array<string>")
    parts = F.when(text.isNotNull() & parts.isNull(), broken).otherwise(parts)
    return F.struct(strip(parts[0]).alias("provider"), strip(parts[1]).alias("model"))
