"""Token ids, wavelet shards, token files and packing against plain encoders and round trips."""

import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cutweave.llm import packing, tokenfiles, tokens, wavelet
from cutweave.llm.common import shared_dir

SCHEMA = "doc_id long, text string, lang string, part int, ids string, rest string"
TEXTS = ["a  b\n\nc", " x", "y ", "", "\n", "it's 'll we 've\tq", "a\x1c b c", "<|endoftext|> z", "naïve École. x¹ ª", "a\n\nb\n", None, "word, " * 3000, "日本 語　x", "Iͅa ǆa, ɐa. ab.. don't."]


def plain(text):
    t = tokens.encoder(tokens.tokenizer_path()).tokenizer
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


def rows(texts):
    return [(i, t, "en", 1, "x", "y") for i, t in enumerate(texts)]


def test_parts_give_the_ids_of_the_whole_text():
    enc = tokens.encoder(tokens.tokenizer_path())
    for _ in range(2):  # the second time from what is known
        got = enc.encode([t or "" for t in TEXTS])
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain(t)[:-1] for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é.,'\n\t 　Éß1ˆ-"), max_size=40))
def test_parts_give_the_ids_of_any_text(text):
    assert np.frombuffer(tokens.encoder(tokens.tokenizer_path()).encode([text])[0], "<u2").tolist() == plain(text)[:-1]


@pytest.mark.parametrize("n,alphabet", [(0, 1), (1, 1), (70_000, 1), (200_000, 700), (65_536, 5), (3, 50_000)])
def test_wavelet_access_count_select_and_round_trip(n, alphabet):
    rng = np.random.default_rng(n + alphabet)
    ids = rng.integers(0, alphabet, n).astype(np.uint16) * (60_000 // alphabet)
    shard = wavelet.Shard(wavelet.build(ids, [5, None], [n - n // 3, n // 3], 1, 2))
    assert (shard.decode() == ids).all() and len(shard) == n
    assert [(d, s, len(x)) for d, s, x in shard.documents()] == [(5, 0, n - n // 3), (None, n - n // 3, n // 3)]
    for i in random.Random(1).sample(range(n), min(n, 40)):
        assert shard.access(i) == ids[i]
    for token in {*ids[:15].tolist(), 1}:
        at = np.flatnonzero(ids == token)
        lo, hi = n // 5, n - n // 7
        assert shard.count(token) == len(at) and shard.count(token, lo, hi) == ((at >= lo) & (at < hi)).sum()
        for k in {0, len(at) // 2, len(at) - 1}:
            assert shard.select(token, k) == (at[k] if 0 <= k < len(at) else -1)
        assert shard.select(token, len(at)) == -1


def test_token_files_hold_all_documents_in_order(spark):
    docs = spark.createDataFrame([*rows(TEXTS), (None, "null id", "en", 1, "x", "y"), (3, "again", "en", 1, "x", "y")], SCHEMA)
    where = shared_dir(spark, "files")
    shards = tokenfiles.write_shards(docs, where, shard_tokens=50)
    start = {(r.part, r.shard): r.start for r in shards.collect()}
    got = sorted((start[r.part, r.shard] + r.inside, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfiles.read_shards(spark, where).collect())
    assert [g[1] for g in got] == sorted([r[0] for r in docs.collect()], key=lambda d: -1 if d is None else d)
    at = 0
    left = [(d, t) for d, t, *_ in docs.collect()]
    for s, d, n, crc in got:
        assert s == at
        at += n
        ids = [i for i in (np.array(plain(t), "<u4") for x, t in left if x == d) if len(i) == n and zlib.crc32(i.tobytes()) == crc]
        assert ids
    assert tokenfiles.write_shards(docs.limit(0), shared_dir(spark, "none")).count() == 0


def test_token_file_query_is_exact(spark):
    sf = "/root/testdata/sf0.001"
    got, at = {r.doc_id: r for r in tokenfiles.op10_tokenfiles(spark, sf).collect()}, 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(plain(r.text), "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), max_size=8), st.integers(1, 60))
def test_closest_fill_is_the_largest_sum(counts, space):
    sums = {0}
    for length, times in counts.items():
        sums = {s + k * length for s in sums for k in range(times + 1) if s + k * length <= space}
    fill = packing.closest_fill(counts, space)
    assert sum(x * k for x, k in fill.items()) == max(sums) and all(k <= counts[x] for x, k in fill.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=12), st.integers(0, 3))
def test_plans_place_each_token_once(histogram, slack):
    plan = packing.make_plan(histogram, 64, slack)
    taken = {}
    for length, n in histogram.items():
        for rank in range(n):
            pieces = plan.pieces(length, rank)
            assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:i]) for i in range(len(pieces))] and sum(p[1] for p in pieces) == length
            for _, n_, seq, off in pieces:
                taken.setdefault(seq, []).append((off, n_))
    for spans in taken.values():
        end = 0
        for off, n_ in sorted(spans):
            assert off == end
            end += n_
        assert end <= 64 and (64 - end <= slack or end & (end - 1) == 0)
    assert set(taken) == set(range(plan.sequences))


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame([*rows(TEXTS), *rows(TEXTS), (None, "null id", "en", 1, "x", "y")], SCHEMA)
    got = packing.pack(docs, window=64).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 and len(r.ids) == 2 * r.length
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or at & (at - 1) == 0
    for i, t in enumerate(TEXTS):
        mine = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == i)
        want = np.array(plain(t), "<u2").tobytes()
        assert b"".join(b for _, b in mine[::2]) == want == b"".join(b for _, b in mine[1::2])
    assert packing.pack(docs.limit(0)).count() == 0


def test_headers_are_readable():
    data = wavelet.build(np.array([1, 2], np.uint16), [1], [2], 0, 0)
    assert json.loads(data[16 : 16 + int.from_bytes(data[8:12], "little")])["n"] == 2
    with pytest.raises(ValueError):
        wavelet.Shard(b"x" * 40)


def test_starts_come_from_the_files(spark, tmp_path):
    where = f"file://{tmp_path}/files"
    tokenfiles.write_shards(spark.createDataFrame(rows(TEXTS), SCHEMA), where, shard_tokens=50)
    files = sorted((tmp_path / "files").glob("*.wvm"))
    lost = wavelet.head_of(files[0].read_bytes())["n"]
    whole = {r.doc_id: r.start for r in tokenfiles.documents_of(spark, where).collect()}
    files[0].unlink()
    less = {r.doc_id: r.start for r in tokenfiles.documents_of(spark, where).collect()}
    assert len(files) > 1 and 0 < len(less) < len(whole) and less == {d: whole[d] - lost for d in less}
