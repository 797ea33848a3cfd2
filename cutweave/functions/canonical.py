"""Canonical JSON of nested values and its hashes: keys sorted at all depths, no spaces, secrets taken out, all as expressions on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT, ARRAY = "map<string,variant>", "array<variant>"
# What of a backend's settings is no part of a run's identity.
SECRETS = {"remote_api": ["api_key"], "openai": ["api_key", "organization", "project"], "gemini": ["api_key"], "qwen3vl": []}
DEPLOYMENT = "single_machine_shared_fs"
MERGE_SECRETS = ["api_key", "organization", "project"]


def fields(v: Column) -> Column:
    """An object's fields as a map; NULL for anything else."""
    return F.try_variant_get(v, "$", OBJECT)


def without(v: Column, names: list[str], depth: int = 0) -> Column:
    """A variant without the fields of these names: those of its own, and with depth those of what it holds, so many objects and arrays
    deep. What is no object stays; NULL stays NULL."""
    inner = (lambda x: without(x, names, depth - 1)) if depth else (lambda x: x)
    kept = lambda m: F.map_filter(m, lambda k, x: ~k.isin(names)) if names else m
    own = fields(v)
    made = F.when(own.isNotNull(), F.to_variant_object(F.transform_values(kept(own), lambda k, x: inner(x)) if depth else kept(own)))
    if depth:
        items = F.try_variant_get(v, "$", ARRAY)
        made = F.coalesce(made, F.when(items.isNotNull(), F.to_variant_object(F.transform(items, inner))))
    return F.coalesce(made, v)


def canonical(v: Column) -> Column:
    """A variant as JSON without spaces, keys sorted at all depths: a variant's objects keep their fields so."""
    return F.to_json(v)


def payload_hash(v: Column) -> Column:
    """sha256 of the canonical JSON."""
    return F.sha2(canonical(v), 256)


def ascii_only(text: Column) -> Column:
    r"""A JSON text with what is not ASCII as \u and four digits; beyond 16 bits as two of these."""
    code = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))

    def shown(c: Column) -> Column:
        n = F.ascii(c)
        pair = F.concat(code(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), code(F.lit(0xDC00) + (n - 0x10000).bitwiseAND(F.lit(0x3FF))))
        return F.when(n < 128, c).when(n < 0x10000, code(n)).otherwise(pair)

    told = F.array_join(F.transform(F.split(text, ""), shown), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), told).otherwise(text)


def reuse_group(key: Column) -> Column:
    """reuse:: and 16 digits of the sha256 of a key's JSON, an array as a variant; empty without a key."""
    return F.coalesce(F.concat(F.lit("reuse::"), F.left(F.sha2(ascii_only(F.to_json(key)), 256), F.lit(16))), F.lit(""))


def reuse_key(subset: Column, sample: Column, job_type: Column, window_pass: Column, window: Column, frames: Column, kind: Column, sheets: bool, sizes: list[int]) -> Column:
    """What makes two jobs share their images, as an array variant: NULL without contact sheets or without a window. sizes are the
    target's width and height, the compression, and the sheet's rows and columns."""
    if not sheets:
        return F.lit(None).cast("variant")
    text = lambda c, other="": F.coalesce(c.cast("string"), F.lit(other))
    parts = [text(subset), text(sample), text(job_type), F.coalesce(F.nullif(text(window_pass), F.lit("")), F.lit("coarse")), window.cast("long"), frames.cast("array<bigint>"), text(kind), *[F.lit(n) for n in sizes]]
    key = F.to_variant_object(F.array(*[p.cast("variant") if i != 5 else F.to_variant_object(p) for i, p in enumerate(parts)]))
    return F.when(window.cast("long").isNotNull(), key)


def identity_payload(config: Column, stages: Column) -> Column:
    """What identifies a run's configuration, as a variant: data sets, windowing, export, the chosen backend with its settings, merging
    and required stages, all without secrets. Sections that the configuration lacks are empty objects; settings of a backend that
    is not known are left out."""
    at = lambda path, kind="variant": F.try_variant_get(config, path, kind)
    empty = F.parse_json(F.lit("{}"))
    section = lambda path: F.coalesce(at(path), empty)
    sets = F.transform(F.coalesce(at("$.datasets", ARRAY), F.array().cast(ARRAY)), lambda d: F.struct(F.try_variant_get(d, "$.root", "string").alias("root"), F.try_variant_get(d, "$.subset", "string").alias("subset")))
    backend = at("$.worker.backend", "string")
    chosen = empty
    for name, secrets in SECRETS.items():
        chosen = F.when(backend == name, without(section(f"$.worker.{name}"), secrets)).otherwise(chosen)
    return F.to_variant_object(F.struct(
        F.lit(DEPLOYMENT).alias("deployment_mode"), sets.alias("datasets"), section("$.windowing").alias("windowing"), section("$.export").alias("export"),
        F.struct(backend.alias("backend"), chosen.alias("selected_backend_config")).alias("worker"), without(section("$.llm_merge"), MERGE_SECRETS).alias("llm_merge"), stages.alias("required_stages"),
    ))
