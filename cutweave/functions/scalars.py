"""Small column functions: captions, codes, paths, hashes, payload bytes, ids and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the languages that subtitles know.
LANGUAGES = {"chinese": "zh", "cn": "zh", "en": "en", "en-gb": "en", "en-us": "en", "english": "en", "zh": "zh", "zh-cn": "zh", "zh-hans": "zh", "中文": "zh"}


def language_code(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])[low], low)


def wrapped(text: Column, width: int = 18) -> Column:
    """Lines of at most width characters: words are laid while they fit; a text without spaces is cut every width."""
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")
    fits = lambda s, w: F.length(F.element_at(s, -1)) + 1 + F.length(w) <= width
    laid = F.aggregate(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 1, 1), lambda s, w: F.when(fits(s, w), F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array(F.concat_ws(" ", F.element_at(s, -1), w)))).otherwise(F.concat(s, F.array(w))))
    n = F.length(F.trim(text))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / width).cast("int") - 1)), lambda i: F.substring(F.trim(text), i * width + 1, F.lit(width)))
    return F.when(F.size(words) > 1, F.array_join(laid, "\n")).when(F.size(words) == 1, F.array_join(cut, "\n")).otherwise("")


def clean_video(fps: Column, nframes: Column) -> tuple[Column, Column]:
    """(frames a second, frames) with defaults of 30 and 0 for what can't be used."""
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    return F.when(bad(fps) | (F.abs(fps) < 1e-6), 30.0).otherwise(fps), F.when(bad(nframes) | (nframes <= 0), 0).otherwise(nframes).cast("long")


def base_url(url: Column, version: str = "v1") -> Column:
    """An address without its last slashes, with a version where it has no path."""
    bare = F.regexp_replace(F.trim(url), "/+$", "")
    return F.when(bare.rlike(r"^[a-z]+://[^/]+$"), F.concat(bare, F.lit(f"/{version}"))).otherwise(bare)


def mime_type(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.endswith(".png"), "image/png").when(low.endswith(".jpg") | low.endswith(".jpeg"), "image/jpeg").when(low.endswith(".webp"), "image/webp").otherwise("application/octet-stream")


def payload(text: Column) -> tuple[Column, Column]:
    """(mime, bytes) of a data URL or of bare base64; NULL bytes for what is neither."""
    url = text.rlike(r"^data:[^;,]+;base64,")
    body = F.when(url, F.substring_index(text, ",", -1)).otherwise(text)
    return F.when(url, F.regexp_extract(text, r"^data:([^;,]+);", 1)).otherwise("image/png"), F.try_to_binary(body, F.lit("base64"))


def config_hash(values: dict[str, Column]) -> Column:
    """sha256 of the values as compact JSON with sorted keys; NULL values are left out."""
    return F.sha2(F.to_json(F.struct(*[v.alias(k) for k, v in sorted(values.items())])), 256)


def task_id(subset: Column, sample: Column, kind: str, number: Column, repeat: Column | None = None) -> Column:
    """subset::sample_<kind><number>[_r<repeat>]; kinds are w, rw, b and seg."""
    head = F.concat(subset, F.lit("::"), sample.cast("string"), F.lit(f"_{kind}"), number.cast("string"))
    return head if repeat is None else F.concat(head, F.lit("_r"), repeat.cast("string"))


def merged_meta(own: Column, added: Column) -> Column:
    """Two maps as one, in which the first one's keys stand."""
    return F.map_concat(F.map_filter(added, lambda k, v: ~F.map_contains_key(own, k)), own)


def distinct_names(names: Column) -> Column:
    """Trimmed names in order of first sight, without blanks and repeats."""
    return F.array_distinct(F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != ""))


def sequence_ids(ids: Column) -> Column:
    """The ids of an array, or its places where any repeats."""
    return F.when(F.size(F.array_distinct(ids)) == F.size(ids), ids).otherwise(F.transform(ids, lambda x, i: i.cast("bigint")))


def dummy_result(images: Column) -> Column:
    """What the deterministic stand-in for a model answers: a cut in the middle of more than eight images, else none."""
    many, half = images > 8, F.floor(images / 2).cast("int")
    return F.struct(F.lit("").alias("thought"), F.when(many, F.array(half)).otherwise(F.array().cast("array<int>")).alias("transitions"), F.when(many, F.array(F.lit("First step"), F.lit("Second step"))).otherwise(F.array(F.lit("Single step"))).alias("instructions"))


def differing(left: str, right: str, names: list[str]) -> Column:
    """The names whose values differ between two structs, NULL being equal to NULL."""
    return F.array_compact(F.array(*[F.when(~F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")), F.lit(n)) for n in names]))
