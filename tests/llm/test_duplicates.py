"""Near-duplicates, recurring lines and fingerprints against brute force."""

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from cutweave.llm import components, linededup, ordermin, pigeonhole, simhash

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "One"), (6, "a b c d e f g h"), (7, "A B c d e f g h"), (None, "a b c d e f g h"), (8, "w " * 40_000), (9, "x\ny\nz"), (10, "a\x0bb c d e f g h")]


def odd(spark):
    rows = [(d, t, "s", 1, "f", "k") for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lines int, fp string, key string")


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, ids, distance=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(prints, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance):
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprints_bit_by_bit():
    for _, text in ODD:
        assert simhash.simhash(text) == slow_print(text)


@pytest.mark.parametrize("cell_pairs", [pigeonhole.CELL_PAIRS, 50])
@pytest.mark.parametrize("distance", [0, 1, 3, 9])
def test_all_links_are_found(spark, monkeypatch, cell_pairs, distance):
    """With few pairs a cell, keys are cut; what hubs leave out is found among all pairs."""
    monkeypatch.setattr(pigeonhole, "CELL_PAIRS", cell_pairs)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = {int(b) for b in base}
    for b in base[:20]:
        for _ in range(6):
            values.add(int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(1, distance + 2), replace=False)))
    for _ in range(60):  # all near one value, so they meet under one key
        values.add(int(base[0]) ^ sum(1 << int(x) for x in rng.choice(12, 4, replace=False)))
    chain = [0]
    for i in range(0, 60, 3):
        chain.append(chain[-1] | 7 << i)
    values = sorted(values | set(chain))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.root for r in components.components(simhash.link(fps, distance)).collect()}
    want = slow_components(values, list(range(len(values))), distance)
    groups = {}
    for x, w in zip(signed, want, strict=True):
        groups.setdefault(w, set()).add(got.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)
    if distance:
        near = {(x, y) for x, a in zip(signed, values, strict=True) for y, b in zip(signed, values, strict=True) if x < y and (a ^ b).bit_count() <= distance}
        asked, nodes = pigeonhole.plan(np.full((64, 64), len(values) / 4), len(values), distance), fps.selectExpr("fp AS node", "fp")
        assert {tuple(r) for r in pigeonhole.meetings(nodes, asked, distance, "all").collect()} == near
        hubs = {tuple(r) for r in pigeonhole.meetings(nodes, asked, distance, "hubs").collect()}
        assert hubs <= near and {x for p in hubs for x in p} == {x for p in near for x in p}
        half = nodes.selectExpr("*", "fp % 2 AS label")
        assert {tuple(r) for r in pigeonhole.meetings(half, asked, distance, "all").collect()} == {(x, y) for x, y in near if np.fmod(x, 2) != np.fmod(y, 2)}


def test_thresholds_sum_to_what_the_pigeonhole_asks():
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < 0.5
    both = bits.T.astype(float) @ bits
    for n in (2, 10_000, 10**7, 10**9):
        for distance in (3, 14):
            asked = pigeonhole.plan(both * n / 500, n, distance)
            assert asked and len({b for _, _, g in asked for b in g}) == sum(len(g) for _, _, g in asked)
        for parts in (2, 3, 4):
            groups = pigeonhole.group_bits(both, 500, parts)
            assert sorted(b for g in groups for b in g) == list(range(64))
            assert sum(pigeonhole.allot(groups, np.full(64, 0.5), n, 3)[1]) == 3 - parts + 1
    assert pigeonhole.plan(both, 500, 0) == []


def test_odd_documents(spark):
    docs = odd(spark)
    got = simhash.near_duplicates(docs).collect()
    ids, prints = [r.doc_id for r in got], [int(r.fingerprint, 16) for r in got]
    assert [r.component_id for r in got] == slow_components(prints, ids) and len(got) == len(ODD)
    assert [r.component_id for r in simhash.near_duplicates(docs, distance=0).collect()] == slow_components(prints, ids, 0)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_texts_are_taken_in_slices(monkeypatch):
    texts = ["a b c d e f g h", "one", "x" * 50, " ".join(f"w{i}" for i in range(300)), "  lead and trail  \n", "a b c", "a b"]
    whole = [(simhash.simhash(t), simhash.shingle_set(t, 5).tolist()) for t in texts]
    monkeypatch.setattr(simhash, "SLICE", 3)
    assert [(simhash.simhash(t), simhash.shingle_set(t, 5).tolist()) for t in texts] == whole
    assert [w[0] for w in whole] == [slow_print(t) for t in texts]
    monkeypatch.undo()
    import tracemalloc

    text = "some words that are repeated often " * 1_500_000  # 52 MB
    tracemalloc.start()
    simhash.simhash(text)
    assert tracemalloc.get_traced_memory()[1] < 4 * len(text)
    tracemalloc.stop()


def test_query_over_all_documents(spark):
    got = simhash.op1_simhash(spark, SF).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = [slow_print(text[r.doc_id]) for r in got]
    assert [f"{p:016x}" for p in prints] == [r.fingerprint for r in got] and len(got) == len(text)
    assert [r.component_id for r in got] == slow_components(prints, [r.doc_id for r in got])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges or [(0, 0)], "u long, v long")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in want:
        for u, v in edges:
            want[u] = want[v] = min(want[u], want[v])
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: want[x] for x in linked}


def test_recurring_lines(spark):
    long = [f"w{chr(97 + i)}" for i in range(20)]
    other = [*long[:10], "new", *long[11:]]
    rows = [
        (1, "keep me alone\n" + " ".join(long) + "\nhi"), (2, " ".join(other) + "\nhi\nTotal of 12 items sold"), (3, "Total of 99 items sold\nmine only here"),
        (4, None), (5, ""), (None, " ".join(long)), (6, " ".join(long)), (6, " ".join(long)), (7, "twice in one\ntwice in one"), (8, "hi\n\nhi\n12 30 7"), (9, "ho\n12 30 8"), (10, "ho"),
    ]
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, lines int, n string")
    got = sorted(((r.doc_id or 0), r.text or "", r.dropped_lines) for r in linededup.drop_recurring(docs).collect())
    assert got == sorted([
        (1, rows[0][1], 0), (2, "Total of 12 items sold", 2), (3, "mine only here", 1), (4, "", 0), (5, "", 0), (0, " ".join(long), 0),
        (6, "", 1), (6, "", 1), (7, rows[8][1], 0), (8, "\n12 30 7", 2), (9, rows[10][1], 0), (10, "ho", 0),
    ])
    same = linededup.drop_recurring(docs, counts=False)
    assert same.columns == docs.columns and same.filter("doc_id = 4").first().text is None
    assert linededup.drop_recurring(docs.limit(0)).count() == 0


def test_passages_recur_wherever_in_a_line_they_stand(spark):
    rng = np.random.default_rng(8)
    say = lambda n, tag: " ".join(f"{tag}{x}".translate(str.maketrans("0123456789", "abcdefghij")) for x in rng.integers(0, 10**6, n)) + "."
    passage = " ".join(say(n, "p") for n in (12, 3, 20, 9, 2, 14))
    changed = passage.split(" ")
    changed[27], changed[55] = "edited", "other"  # behind the leading third of their sentences
    texts = [say(30, "a") + " " + passage + " " + say(9, "b"), say(4, "c") + " " + passage, "x\n" + say(11, "d") + " " + " ".join(changed) + " " + say(40, "e"), say(100, "f"), passage]
    got = [r.text for r in linededup.drop_recurring(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    windows = lambda t: {tuple(t.split()[i : i + 12]) for i in range(len(t.split()) - 11)}
    assert got[0] == texts[0] and got[3] == texts[3] and len(got[4].split()) < linededup.SENTENCE
    assert all(not windows(got[k]) & windows(passage) for k in (1, 2)) and got[1].startswith(texts[1][:20])
    assert all(w in got[2].split() for w in texts[2].split() if w[0] in "d" or (w[0] == "e" and w != "edited"))


def dropped(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in linededup.drop_recurring(docs).orderBy("doc_id").collect()]


def test_families_of_a_leaf_have_templates_of_their_own(spark):
    """Twelve tokens and the same leading four: three lines of one family and three of another."""
    one = [f"the old red house {w} under tall trees by the wide river" for w in ("stood", "slept", "waited")]
    two = [f"the old red house where many cats and dogs often {w} today" for w in ("play", "hide", "rest")]
    got = dropped(spark, [one[0], two[0], one[1], two[1], one[2], two[2]])
    assert got == [one[0], two[0], "", "", "", ""]


def test_short_lines_are_generalised_from_three_documents_on(spark):
    texts = [f"Meet {name} at noon" for name in ("John", "Mary", "Paul", "Anna")] + ["Ask Eve at nine", "Ask Tom at nine"]
    assert dropped(spark, texts) == [texts[0], "", "", "", *texts[4:]]


def test_two_documents_that_differ_in_a_word_keep_it(spark):
    texts = [f"It was {w} and {v} when the treaty between both powers was signed in Rome by the king of {w}" for w, v in (("France", "cold"), ("Spain", "warm"))]
    same = [f"The treaty between both of the old powers was signed in Rome by the king of {w}" for w in ("France", "Spain")]
    assert dropped(spark, texts) == texts and dropped(spark, same) == same
    assert dropped(spark, [*same, same[0].replace("France", "Peru")])[1:] == ["", ""]


def test_long_sentences_are_whole_pieces(spark):
    """Neither 3.14 nor 60 words end a sentence; other texts around a passage change none of its pieces."""
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) + " is 3.14 or so."
    got = dropped(spark, [f"Yes. {passage} No.", f"What now? Well. {passage} Some of it stays here.", passage + "  "])
    assert got == [f"Yes. {passage} No.", "What now? Well. Some of it stays here.", ""]


def test_many_lines_of_one_document(spark):
    lines = [f"the line number {''.join(chr(97 + int(c)) for c in str(i))} of a long log" for i in range(30_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines[::2])), (2, "\n".join(lines))], "doc_id long, text string")
    assert [r.dropped_lines for r in linededup.drop_recurring(docs).orderBy("doc_id").collect()] == [0, 15_000]


def signatures(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: {(s.slot, s.sig) for s in r.s} for r in df.select("i", ordermin.signature(df.t).alias("s")).collect()}


def chained(*parts):
    seed = 42
    for x in parts:
        seed = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else (x & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed


def slow_signature(text):
    """Order MinHash in plain Python: k-mers with occurrence numbers, the smallest of each slot, hashed in text order."""
    import re

    words = [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = [(words[i : i + 3] + [b""] * 3)[:3] for i in range(max(len(words) - 2, min(len(words), 1)))]
    by_hash = {}
    for i, g in enumerate(grams):  # a k-mer is known by 33 bits of its hash, of the hash of its three words
        by_hash.setdefault(chained(chained(*g)) >> 31, []).append(i)
    placed = sorted((h if not j else chained(h, (j).to_bytes(4, "little")) >> 31, i) for h, at in by_hash.items() for j, i in enumerate(at))
    slots = {}
    for h, i in placed:
        slots.setdefault(h >> 27, []).append(i)
    out = set()
    for slot, at in slots.items():
        sig = 0
        for i in sorted(at[:2]):
            sig = chained(sig, chained(*grams[i]))
        out.add((slot, sig - (1 << 64) if sig >> 63 else sig))
    return out


def slow_likeness(a, b):
    slots = {s for s, _ in a} | {s for s, _ in b}
    return len(a & b) / len(slots) if slots else 1.0


def test_signatures_by_brute_force(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "bb", "ü", "d"], n)) for n in (0, 1, 2, 3, 4, 7, 30, 300)] + [" ".join(f"w{i}" for i in range(400)), "x " * 500, None, "\ta\x0b b\nc "]
    assert signatures(spark, texts) == {i: slow_signature(t) for i, t in enumerate(texts)}


def test_order_and_repeats_count(spark):
    a = " ".join(f"w{i}" for i in range(300))
    words = a.split()
    moved = " ".join(words[150:] + words[:150])
    sig = signatures(spark, [a, a, moved, " ".join(words[::-1]), "", None, "x x x x x x x", "x x x x", a + " end", "ü"])
    like = lambda i, j: len(sig[i] & sig[j]) / len({s for s, _ in sig[i]} | {s for s, _ in sig[j]})
    assert sig[0] == sig[1] and sig[4] == sig[5] == set() and sig[9]
    assert like(0, 8) > like(0, 2) > like(0, 3) and sig[6] != sig[7]


def test_occurrence_numbers(spark):
    df = spark.createDataFrame([([7] * 5 + [9] + [7],)], "h array<bigint>")
    packed = df.select(ordermin.numbered(df.h).alias("n")).first().n
    assert len(packed) == 7 and len({x >> ordermin.POS_BITS for x in packed}) == 7 and sorted(x & ((1 << 30) - 1) for x in packed) == list(range(7))


def test_next_documents_and_edits(spark):
    docs = odd(spark)
    got = {(r.doc_id, r.n_chars): r for r in ordermin.fingerprint_pairs(docs, blocks=3).collect()}
    text = {d: t or "" for d, t in ODD if d is not None}
    order = sorted(text)
    import hashlib

    for d in (5, 6, 7, 9, 10):
        nxt = order[(order.index(d) + 1) % len(order)] if d != 10 else None
        n, t = len(text[d]), text[d]
        after = text[nxt] if nxt else "a b c d e f g h"  # after the last comes the row without an id
        want = t[: n - n // 2] + after[: n // 2]
        assert got[d, n].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        own = slow_signature(t)
        assert got[d, n].near_edited == slow_likeness(own, slow_signature(want)) and got[d, n].near_next == slow_likeness(own, slow_signature(after))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    same = [tuple(r) for r in ordermin.fingerprint_pairs(docs, blocks=1).collect()]
    assert sorted(map(str, same)) == sorted(map(str, (tuple(r) for r in ordermin.fingerprint_pairs(docs, blocks=8).collect())))
    assert ordermin.fingerprint_pairs(docs.limit(0)).count() == 0 and ordermin.fingerprint_pairs(docs.filter("doc_id = 6")).first().near_next == 1.0


def test_edits_of_all_documents(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    import hashlib

    got = {r.doc_id: r for r in ordermin.op7_ordermin(spark, SF).collect()}
    for i, (d, t) in enumerate(docs):
        after, n = docs[(i + 1) % len(docs)][1], len(t)
        if n < 4000:
            own = slow_signature(t)
            shown = {int(k): v for k, v in ((k, got[d].fingerprint[16 * k : 16 * k + 16]) for k in range(64)) if v[0] != "."}
            assert shown == {k: f"{v & (1 << 64) - 1:016x}" for k, v in own} and got[d].near_next == slow_likeness(own, slow_signature(after))
            assert got[d].near_edited == slow_likeness(own, slow_signature(t[: n - n // 2] + after[: n // 2]))
        assert got[d].n_chars == n and got[d].edited_sha256 == hashlib.sha256((t[: n - n // 2] + after[: n // 2]).encode()).hexdigest()
    prints = {}
    for d, t in docs:
        prints.setdefault(t, set()).add(got[d].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.9


def slow_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """The ids that stay of (id, text) by brute force: sets of shingles with a Jaccard of 0.8 or more and near fingerprints are linked."""
    sets, root = [slow_shingles(t) for _, t in rows], list(range(len(rows)))
    prints = [(simhash._majority([h]), simhash._majority([simhash.mixed(h)])) for h in (simhash.shingle_set(t, 5) for _, t in rows)]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                low, high = ((x ^ y).bit_count() for x, y in zip(prints[i], prints[j], strict=True))
                if low <= simhash.NEAR_DISTANCE and low + high <= simhash.NEAR_TOTAL:
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted(d for _, d in least.values())


def test_one_of_each_group_of_near_duplicates_stays(spark):
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{i}" for i in range(400)]
    for n in (3, 9, 30, 120, 200):
        for _ in range(4):
            base = list(rng.choice(words, n))
            for _ in range(6):
                copy = list(base)
                for at in rng.integers(0, n, rng.integers(0, max(2, n // 20))):
                    copy[at] = f"x{rng.integers(1000)}"
                rows.append((len(rows) + 10, " ".join(copy)))
    common = " ".join(rng.choice(words, 60))
    rows += [(500 + i, common + " " + " ".join(rng.choice(words, i))) for i in range(40)]
    rows += [(d, t) for d, t in ODD if d != 4]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id or 0 for r in got.collect()) == slow_kept(rows)


def test_repeated_and_missing_ids_are_judged_by_their_texts(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "near copy"), (3, "near copy"), (3, "other text"), (3, "other text"), (None, "alone"), (None, "alone"), (None, "near copy"), (5, None), (6, ""), (7, long), (7, long + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == 5 and {(1, "near copy"), (3, "other text"), (None, "alone"), (5, None)} < set(kept) and sum(d == 7 for d, _ in kept) == 1
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_near_dedup_stage_takes_copies_with_several_edits(spark):
    words = [f"w{i}" for i in range(300)]
    edited = [f"x{i}" if i in (20, 90, 160, 230) else w for i, w in enumerate(words)]
    docs = odd(spark).limit(0).unionByName(spark.createDataFrame([(1, " ".join(words), "s", 1, "f", "k"), (2, " ".join(edited), "s", 1, "f", "k")], "doc_id long, text string, source string, lines int, fp string, key string"))
    got = corpus_pipeline.near_duplicates_out(spark, docs, SF)
    assert got.columns == docs.columns and [r.doc_id for r in got.collect()] == [1]


def test_near_dedup_of_all_documents(spark):
    """Of the pairs of Jaccard 0.8 or more in the documents, how many the stage's distance takes; and all of those are taken."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    assert got == slow_kept(rows)
