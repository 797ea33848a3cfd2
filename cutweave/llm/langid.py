"""Language ID by a linear-chain conditional random field over the words of a text.

A word's features are its letters as a whole (the lexicon), its first and last one to three bytes, and its byte trigrams, each
hashed to a row of weights, one for each language. Transitions between the languages of neighbouring words are learned. Words
are labelled by forward-backward, so a text may switch languages; the text's language is the one with the largest sum of
posteriors. Long texts are cut into blocks whose transfer matrices are multiplied, which is exact.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .learning import known_fold, labelled_sample, trained
from .words import Words, mix, slices, words_of

BITS = 17
FOLDS, HELD = 3, 1
#: Labelled documents to learn from.
MOST = 3_000
BLOCK, EPOCHS, BATCH, RATE = 64, 2, 256, 0.3
UNKNOWN = "und"
#: Languages that a model may tell apart; more are refused, since its size grows with them.
MOST_LANGS = 128


def _fold_accents(raw: np.ndarray) -> np.ndarray:
    """Lower case for the capitals of the two-byte Latin letters from U+00C0 to U+00DE."""
    out = raw.copy()
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    capital = second[(raw[second] >= 0x80) & (raw[second] <= 0x9E) & (raw[second] != 0x97)]
    out[capital] += 0x20
    return out


def word_features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind of each word, first, index): the distinct words and, for each, its features index[first[k]:first[k + 1]].

    Words are taken without ASCII punctuation at their sides; a word of punctuation or digits alone has no features.
    """
    w.raw = _fold_accents(w.raw)
    start, end = w.stripped()
    real = np.flatnonzero(start < end)
    h = np.zeros(len(start), np.uint64)
    h[real] = w.hashes(start[real], end[real])
    _, example, kind = np.unique(h, return_index=True, return_inverse=True)
    s, e = start[example], end[example]
    size = np.maximum(e - s, 0)
    place = lambda x, k: (mix(x * np.uint64(31) + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64)
    alphabetic = np.concatenate([[0], np.cumsum(w.raw > 64)])
    letters = (size > 0) & (alphabetic[np.maximum(s, e)] > alphabetic[s])
    at, of = [place(h[example], 0)[letters]], [np.flatnonzero(letters)]
    head, tail = np.zeros(len(s), np.uint64), np.zeros(len(s), np.uint64)
    for k in range(3):
        long = np.flatnonzero(letters & (size > k))
        head[long] |= w.raw[s[long] + k].astype(np.uint64) << np.uint64(8 * k)
        tail[long] |= w.raw[e[long] - 1 - k].astype(np.uint64) << np.uint64(8 * k)
        at += [place(head[long], 1 + k), place(tail[long], 4 + k)]
        of += [long, long]
    grams = np.where(letters, np.maximum(size - 2, 0), 0)
    word = np.repeat(np.arange(len(s)), grams)
    p = s[word] + np.arange(len(word)) - np.repeat(np.cumsum(grams) - grams, grams)
    raw = w.raw.astype(np.uint64)
    at.append(place(raw[p] | raw[p + 1] << np.uint64(8) | raw[p + 2] << np.uint64(16), 7))
    of.append(word)
    at, of = np.concatenate(at), np.concatenate(of)
    turn = np.argsort(of, kind="stable")
    return kind, np.searchsorted(of[turn], np.arange(len(s) + 1)), at[turn]


def emissions(first: np.ndarray, index: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """For each distinct word, the mean of its features' weights times the root of their number; 0 without features."""
    out = np.zeros((len(first) - 1, table_.shape[1]))
    has = np.flatnonzero(first[1:] > first[:-1])
    if len(has):
        out[has] = np.add.reduceat(table_[index], first[has], axis=0) / np.sqrt(first[has + 1] - first[has])[:, None]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def posteriors(psi: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """psi: potentials of the words of all texts, text i from first[i] to first[i + 1]; trans: potentials of transitions.

    A text begins after any language alike. Each text is cut into blocks; the longest blocks come first, so that each step works
    on a leading part of them.
    """
    L, sizes = psi.shape[1], np.diff(first)
    blocks = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), blocks)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = first[doc] + turn * BLOCK
    size = np.minimum(BLOCK, first[doc + 1] - start)
    by_size = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[by_size], -np.arange(BLOCK), "left")  # blocks with more than k words
    start = start[by_size]
    transfer = np.tile(np.eye(L), (len(doc), 1, 1))
    for k in range(BLOCK):
        if not (n := live[k]):
            break
        step = (transfer[:n].reshape(-1, L) @ trans).reshape(n, L, L) * psi[start[:n] + k][:, None, :]
        transfer[:n] = step / step.sum(axis=(1, 2), keepdims=True)
    ordered = np.empty_like(transfer)
    ordered[by_size] = transfer
    before, after = np.full((len(doc), L), 1 / L), np.full((len(doc), L), 1 / L)
    base = np.cumsum(blocks) - blocks
    for j in range(1, int(blocks.max(initial=0))):
        at = base[blocks > j] + j
        before[at] = _unit(np.einsum("bi,bij->bj", before[at - 1], ordered[at - 1]))
    for j in range(int(blocks.max(initial=0)) - 1, 0, -1):
        at = base[blocks > j] + j
        after[at - 1] = _unit(np.einsum("bij,bj->bi", ordered[at], after[at]))
    a, b = before[by_size], after[by_size]
    out = np.empty_like(psi)
    for k in range(BLOCK):
        if not (n := live[k]):
            break
        a[:n] = _unit((a[:n] @ trans) * psi[start[:n] + k])
        out[start[:n] + k] = a[:n]
    for k in range(BLOCK - 1, -1, -1):
        if not (n := live[k]):
            continue
        here = start[:n] + k
        out[here] = _unit(out[here] * b[:n])
        b[:n] = _unit((psi[here] * b[:n]) @ trans.T)
    return out


def _potentials(e: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(e - e.max(axis=1, keepdims=True), -30, 0))


def fit(langs: list[str]):
    """A function that learns from batches of (text, y), y a place in langs, and gives the model's bytes.

    Texts have one language each; sequences with switches are made by laying runs of 4 to 40 words of all texts end to end in a
    seeded order.
    """

    def run(batches) -> bytes:
        L, rng = len(langs), np.random.default_rng(7)
        firsts, indexes, kinds, labels, runs, offset, words = [], [], [], [], [], 0, 0
        for batch in batches:
            for part in slices(batch):
                w = words_of(part.column("text"))
                kind, first, index = word_features(w)
                firsts.append(np.diff(first))
                indexes.append(index)
                kinds.append(kind + offset)
                offset += len(first) - 1
                for i, y in enumerate(part.column("y").to_pylist()):
                    at = int(w.first[i])
                    while at < w.first[i + 1]:
                        to = min(int(w.first[i + 1]), at + int(rng.integers(4, 41)))
                        runs.append((words + at, words + to, int(y)))
                        at = to
                words += len(kind)
        model, trans = np.zeros((1 << BITS, L)), np.zeros((L, L))
        if runs and L > 1:
            kind, index = np.concatenate(kinds), np.concatenate(indexes)
            first = np.concatenate([[0], np.cumsum(np.concatenate(firsts))])
            order = rng.permutation(len(runs))
            seq = np.concatenate([np.arange(runs[k][0], runs[k][1]) for k in order])
            label = np.concatenate([np.full(runs[k][1] - runs[k][0], runs[k][2]) for k in order])
            shape = (-(-len(seq) // BLOCK), BLOCK) if len(seq) >= BLOCK else (1, len(seq))
            seq, label = np.resize(seq, shape), np.resize(label, shape)  # the last row is filled up with the first words
            seen, seen_t = np.full((1 << BITS, L), 1e-2), np.full((L, L), 1e-2)
            for epoch in range(EPOCHS):
                for lo in range(0, len(seq), BATCH):
                    _step(model, trans, seen, seen_t, kind[seq[lo : lo + BATCH]], label[lo : lo + BATCH], first, index)
        head = json.dumps({"langs": langs}).encode()
        return len(head).to_bytes(4, "little") + head + model.astype("<f4").tobytes() + trans.astype("<f4").tobytes()

    return run


def _step(model, trans, seen, seen_t, kinds, labels, first, index) -> None:
    """One step of gradient ascent on the log-likelihood of a batch of sequences of one length."""
    B, T = kinds.shape
    L = trans.shape[0]
    distinct, inverse = np.unique(kinds, return_inverse=True)
    inverse = inverse.reshape(B, T)
    counts = first[distinct + 1] - first[distinct]
    feats = index[np.repeat(first[distinct], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    psi, A = _potentials(emissions(bounds, feats, model))[inverse], np.exp(trans)
    alpha, beta = np.empty((B, T, L)), np.ones((B, T, L))
    a = np.full((B, L), 1 / L)
    for t in range(T):
        a = _unit((a @ A) * psi[:, t])
        alpha[:, t] = a
    for t in range(T - 2, -1, -1):
        beta[:, t] = _unit((psi[:, t + 1] * beta[:, t + 1]) @ A.T)
    post = _unit(alpha * beta)
    ahead = (psi * beta)[:, 1:]
    pair = alpha[:, :-1, :, None] * A * ahead[:, :, None, :]
    grad_t = np.bincount((labels[:, :-1] * L + labels[:, 1:]).ravel(), minlength=L * L).reshape(L, L) - (pair / pair.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))
    grad = -post
    np.put_along_axis(grad, labels[:, :, None], np.take_along_axis(grad, labels[:, :, None], 2) + 1, 2)
    by_word = np.stack([np.bincount(inverse.ravel(), grad[:, :, j].ravel(), minlength=len(distinct)) for j in range(L)], axis=1)
    by_word /= np.sqrt(np.maximum(counts, 1))[:, None]
    rows, row = np.unique(feats, return_inverse=True)
    owner = np.repeat(np.arange(len(distinct)), counts)
    g = np.stack([np.bincount(row, by_word[owner, j], minlength=len(rows)) for j in range(L)], axis=1)
    seen[rows] += g * g
    model[rows] += RATE * g / np.sqrt(seen[rows])
    seen_t += grad_t * grad_t
    trans += RATE * grad_t / np.sqrt(seen_t)


def loaded(data: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    langs = json.loads(data[4 : 4 + n])["langs"]
    values, L = np.frombuffer(data[4 + n :], "<f4").astype(np.float64), len(langs)
    return langs, values[: L << BITS].reshape(1 << BITS, L), values[L << BITS :].reshape(L, L)


def train(docs: DataFrame, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> bytes:
    """Learns from the rows of docs with an id and a language; their languages, few by nature, go to the driver."""
    known = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    langs = sorted(r[0] for r in known.select(lang_col).distinct().limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"over {MOST_LANGS} languages: the model has a column for each")
    places = F.array(*[F.lit(x) for x in langs]) if langs else F.array().cast("array<string>")
    label = known.select(F.col(id_col).alias("doc_id"), (F.array_position(places, F.col(lang_col)) - 1).alias("y"))
    return trained(labelled_sample(known, label, most, id_col, text_col), fit(langs))


def labelled_words(text: str, data: bytes) -> list[tuple[str, str, float]]:
    """(word, language, posterior) for the words of one text."""
    langs, model, trans = loaded(data)
    w = words_of(pa.array([text]))
    kind, first, index = word_features(w)
    if not len(kind) or not langs:
        return []
    p = posteriors(_potentials(emissions(first, index, model))[kind], w.first, np.exp(trans))
    return [(w.text[s:e].tobytes().decode(), langs[int(k)], float(x[k])) for s, e, x, k in zip(w.start, w.end, p, p.argmax(axis=1), strict=True)]


def predict(docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, shares (each language's mean posterior, in the order of the languages) for each row of docs.

    A NULL text and one without a letter are und with score 0 and no shares, as is every text where nothing was learned.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(data)  # the size is fixed by BITS and the languages
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    def run(batches):
        langs, model, trans = loaded(held.value)
        A = np.exp(trans)
        for batch in batches:
            for part in slices(batch):
                ok = np.array(part.column("letter").to_pylist(), bool)
                w = words_of(part.column("text"))
                share = np.zeros((part.num_rows, len(langs)))
                n = np.diff(w.first)
                ok &= (n > 0) & bool(langs)
                if len(w.start) and langs:
                    kind, first, index = word_features(w)
                    p = posteriors(_potentials(emissions(first, index, model))[kind], w.first, A)
                    total = np.vstack([np.zeros(len(langs)), np.cumsum(p, axis=0)])
                    share = (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(n, 1)[:, None]
                best = share.argmax(axis=1) if langs else np.zeros(part.num_rows, int)
                name = [langs[int(k)] if good else UNKNOWN for k, good in zip(best, ok, strict=True)]
                top = [float(min(1.0, max(0.0, share[i, k]))) if good else 0.0 for i, (k, good) in enumerate(zip(best, ok, strict=True))]
                shares = [share[i].tolist() if good else [] for i, good in enumerate(ok)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(name, pa.string()), pa.array(top, pa.float64()), pa.array(shares, pa.list_(pa.float64()))], ["doc_id", "lang_pred", "score", "shares"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), has_letter.alias("letter")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, shares array<double>")


def op4_langid(spark, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), known_fold(F.col("doc_id"), FOLDS, HELD)
    return predict(docs, train(docs.filter(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")
