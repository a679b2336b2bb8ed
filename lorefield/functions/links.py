"""Masking Markdown links and images, and putting them back."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.strings import as_column, once

# The link and image patterns; (?d) lets '.' stop at '\n' only.
IMAGE = r"(?d)!\[.*?\]\(.*?\)"
LINK = r"(?d)\[(.*?)\]\(.*?\)"
IMAGE_KEY = r"<img\d+>"
TARGET = r"(?d)\((.*?)\)"
ANY_KEY = r"<[^<>]*>"
PLAIN_KEY = r"^<[^<>\[\]]*>$"

_ENTRY = "array<struct<key:string,value:string>>"
#: Links above which a text is masked in one pass in Python: array lookups cost the square of the links.
MANY = 256


def _found(text: Column, pattern: str) -> Column:
    """All matches; texts without any link skip the pattern."""
    return F.when(text.contains("]("), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _fold(text: Column, entries: Column, old: str, new: str) -> Column:
    return F.aggregate(entries, text, lambda t, e: F.replace(t, e[old], e[new]))


def _mask(text: Column, found: Column, keys: Column, entries: Column, pattern: str, opener: str) -> Column:
    """Replace each match by the key of its first equal, everywhere in the text.

    If no match holds a second opener, no match can be part of another one, and
    putting keys between the pieces of the split text is the same in one pass.
    """
    alone = F.forall(found, lambda m: F.length(F.replace(m, F.lit(opener), F.lit(""))) == F.length(m) - len(opener))
    key_of = lambda m: F.coalesce(F.get(keys, (F.array_position(found, m) - 1).cast("int")), F.lit(""))
    pieces = F.zip_with(F.split(text, pattern), found, lambda piece, m: F.concat(piece, key_of(m)))
    return F.when(F.size(keys) == 0, text).when(alone, F.array_join(pieces, "")).otherwise(
        _fold(text, entries, "value", "key"))


def _unique(every: Column, keys: Column) -> Column:
    """One entry per key, at the place of its first and with the value of its last use."""
    firsts = F.filter(every, lambda e, i: F.array_position(keys, e["key"]) == i + 1)

    def last_values(backwards: Column, back: Column) -> Column:
        return F.transform(firsts, lambda e: F.struct(
            e["key"].alias("key"),
            F.get(backwards, (F.array_position(back, e["key"]) - 1).cast("int"))["value"].alias("value")))

    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, once(F.reverse(every), lambda b: once(F.reverse(keys), lambda k: last_values(b, k)))).otherwise(every)


def _mask_once(text: str, matches: list[str], keys: list[str], pattern: str, opener: str) -> str:
    """As ``_mask``: literal and key parts in one pass; matches within matches are replaced one after the other."""
    if not keys:
        return text
    first: dict[str, str] = {}
    for m, key in zip(matches, keys):
        first.setdefault(m, key)
    if all(m.count(opener) == 1 for m in first):
        return re.sub(pattern, lambda m: first[m[0]], text)
    for m, key in zip(matches, keys):
        text = text.replace(m, key)
    return text


def _mask_text(text: str) -> dict:
    """What ``mask_links`` gives for one text, with costs in proportion to it."""
    image, link = (p.removeprefix("(?d)") for p in (IMAGE, LINK))
    images = re.findall(image, text)
    image_keys = [f"<img{i}>" for i in range(1, len(images) + 1)]
    text = _mask_once(text, images, image_keys, image, "![")
    links = [(m[0], m[1]) for m in re.finditer(link, text)]
    seen: Counter = Counter()
    link_keys = []
    for _, label in links:
        seen[label] += 1
        link_keys.append(f"<{label}{seen[label] if seen[label] > 1 else ''}>")
    whole = [m for m, _ in links]
    masked = _mask_once(text, whole, link_keys, link, "[")
    # A repeated key keeps its first place and its last value.
    entries: dict[str, str] = {}
    for key, value in zip([*image_keys, *link_keys], [*images, *whole]):
        entries[key] = value
    return {"masked": masked, "link_map": [{"key": k, "value": v} for k, v in entries.items()]}


def _masked_many(text: Column) -> Column:
    @F.arrow_udf(f"struct<masked:string,link_map:{_ENTRY}>")
    def mask(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("masked", pa.string()), ("link_map", pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())])))])
        return pa.array([None if t is None else _mask_text(t) for t in texts.to_pylist()], kind)

    return mask(text)


def mask_links(df: DataFrame, text: str, masked: str = "masked", link_map: str = "link_map") -> DataFrame:
    """Replace images by ``<img1>, <img2>, ..`` and links by ``<label>, <label2>, ..``.

    Each replacement acts on the whole text, so a repeated image shows its
    first key everywhere while the numbering goes on. ``link_map`` lists key
    and original in the order they were found. Texts with over ``MANY`` links
    take one linear pass in Python, others stay in the JVM; results are the same.
    """
    links = (F.length(text) - F.length(F.replace(F.col(text), F.lit("](")))) / 2
    step = df.withColumn("_big", F.coalesce(links > MANY, F.lit(False))).withColumn("_many", _masked_many(F.when(F.col("_big"), F.col(text))))
    step = step.withColumn("_own", F.when(~F.col("_big"), F.col(text)))
    step = step.withColumn("_img", F.transform(
        _found(F.col("_own"), IMAGE), lambda m, i: F.struct(F.concat(F.lit("<img"), (i + 1).cast("string"), F.lit(">")).alias("key"), m.alias("value"))))
    # Keys and values are columns of their own, so lambdas read them instead of making them again.
    step = step.withColumns({"_images": F.transform("_img", lambda e: e["value"]),
                             "_img_keys": F.transform("_img", lambda e: e["key"])})
    step = step.withColumn("_t", _mask(F.col("_own"), F.col("_images"), F.col("_img_keys"), F.col("_img"), IMAGE, "!["))
    step = step.withColumn("_links", _found(F.col("_t"), LINK))
    step = step.withColumn("_labels", F.transform("_links", lambda m: F.regexp_extract(m, LINK, 1)))

    def link_entry(label: Column, i: Column) -> Column:
        seen = F.slice(F.col("_labels"), 1, i + 1)
        nth = F.size(seen) - F.size(F.array_remove(seen, label))
        number = F.when(nth > 1, nth.cast("string")).otherwise(F.lit(""))
        return F.struct(F.concat(F.lit("<"), label, number, F.lit(">")).alias("key"),
                        F.get(F.col("_links"), i).alias("value"))

    step = step.withColumn("_link", F.transform("_labels", link_entry))
    step = step.withColumn("_link_keys", F.transform("_link", lambda e: e["key"]))
    step = step.withColumn("_short", _mask(F.col("_t"), F.col("_links"), F.col("_link_keys"), F.col("_link"), LINK, "["))
    step = step.withColumns({"_all": F.concat(F.col("_img").cast(_ENTRY), F.col("_link").cast(_ENTRY)),
                             "_all_keys": F.concat("_img_keys", "_link_keys")})
    step = step.withColumns({masked: F.when(F.col("_big"), F.col("_many.masked")).otherwise(F.col("_short")),
                             link_map: F.when(F.col("_big"), F.col("_many.link_map").cast(_ENTRY)).otherwise(_unique(F.col("_all"), F.col("_all_keys")))})
    return step.drop("_big", "_many", "_own", "_short", "_img", "_images", "_img_keys", "_t", "_links", "_labels", "_link", "_link_keys", "_all", "_all_keys")


def plain_keys(link_map: Column | str) -> Column:
    """The keys of a map if putting one original back cannot make another key appear, else null."""
    entries = as_column(link_map)
    plain = F.forall(entries, lambda e: e["key"].rlike(PLAIN_KEY) & ~e["value"].contains("<"))
    return F.when(plain, F.transform(entries, lambda e: e["key"]))


def restore_links(text: Column | str, link_map: Column | str, keys: Column | None = None) -> Column:
    """Put every original back, in the order of the map.

    With ``plain_keys`` of the map only the keys that the text shows are looked
    at, which matters where one map serves many chunks.
    """
    col, entries = as_column(text), as_column(link_map)
    every = _fold(col, entries, "key", "value")
    if keys is None:
        return every
    shown = F.array_distinct(F.regexp_extract_all(col, F.lit(ANY_KEY), F.lit(0)))
    places = F.array_sort(F.filter(F.transform(shown, lambda k: F.array_position(keys, k)), lambda i: i > 0))
    present = F.transform(places, lambda i: F.get(entries, (i - 1).cast("int")))
    return F.when(~col.contains("<"), col).when(keys.isNotNull(), _fold(col, present, "key", "value")).otherwise(every)


def image_urls(text: Column | str, link_map: Column | str) -> Column:
    """Targets of the image keys in a masked text, in order, joined with ``;``."""
    entries = as_column(link_map)
    found = F.transform(
        F.regexp_extract_all(as_column(text), F.lit(IMAGE_KEY), F.lit(0)),
        lambda k: F.try_element_at(F.transform(
            F.filter(entries, lambda e: (e["key"] == k) & e["value"].rlike(TARGET)),
            lambda e: F.regexp_extract(e["value"], TARGET, 1)), F.lit(1)))
    return F.when(as_column(text).contains("<img"), F.array_join(found, ";")).otherwise(F.lit(""))
