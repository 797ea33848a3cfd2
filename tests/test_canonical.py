"""Canonical JSON and its hashes against Python's."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cutweave.functions import canonical

BODIES = ['{"b":[{"z":1,"a":null},[],{}],"a":{"é":"x","B":true,"b":"\\u00fc\\n"}}', "[3,1,{}]", '"t"', "7", "null", '{"k":{"api_key":1,"x":[{"api_key":2,"y":3}]},"api_key":4}']


def dumped(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def cut(x, names, depth):
    if isinstance(x, dict):
        return {k: cut(v, names, depth - 1) if depth else v for k, v in x.items() if k not in names}
    return [cut(v, names, depth - 1) for v in x] if isinstance(x, list) and depth else x


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_keys_are_sorted_and_secrets_gone(spark, depth):
    df = spark.createDataFrame([(b,) for b in BODIES], "b string")
    v = F.parse_json("b")
    rows = df.select("b", canonical.canonical(v).alias("c"), canonical.payload_hash(v).alias("h"), canonical.canonical(canonical.without(v, ["api_key"], depth)).alias("w")).collect()
    for r in rows:
        x = json.loads(r.b)
        assert r.c == dumped(x) and r.h == hashlib.sha256(dumped(x).encode()).hexdigest() and r.w == dumped(cut(x, ["api_key"], depth))
    assert df.select(canonical.payload_hash(F.lit(None).cast("variant"))).first()[0] is None


def test_reuse_groups_are_those_of_the_key(spark):
    df = spark.createDataFrame([("ä😀", 5, "3", [1, 2]), ("s", 6, None, [])], "subset string, sample long, pass string, frames array<long>")
    window = F.when(F.col("sample") == 5, 9)
    groups = lambda sheets: [r[0] for r in df.select(canonical.reuse_group(canonical.reuse_key(F.col("subset"), F.col("sample"), F.lit("j"), F.col("pass"), window, F.col("frames"), F.lit("k"), sheets, [1, 2]))).collect()]
    key = json.dumps(["ä😀", "5", "j", "3", 9, [1, 2], "k", 1, 2], separators=(",", ":"))
    assert groups(True) == ["reuse::" + hashlib.sha256(key.encode()).hexdigest()[:16], ""] and groups(False) == ["", ""]


def test_an_identity_has_no_secrets(spark):
    config = '{"worker":{"backend":"gemini","gemini":{"api_key":"k","model":"m"}},"llm_merge":{"organization":"o","on":true},"datasets":[{"root":"r","subset":"s","x":1}]}'
    got = [json.loads(spark.createDataFrame([(c,)], "c string").select(F.to_json(canonical.identity_payload(F.parse_json("c"), F.array(F.lit("a"))))).first()[0]) for c in (config, "{}")]
    base = {"deployment_mode": canonical.DEPLOYMENT, "windowing": {}, "export": {}, "required_stages": ["a"]}
    assert got[0] == base | {"datasets": [{"root": "r", "subset": "s"}], "worker": {"backend": "gemini", "selected_backend_config": {"model": "m"}}, "llm_merge": {"on": True}}
    assert got[1] in (base | {"datasets": [], "worker": {"selected_backend_config": {}}, "llm_merge": {}}, base | {"datasets": [], "worker": {"backend": None, "selected_backend_config": {}}, "llm_merge": {}})
