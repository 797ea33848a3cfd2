"""Line dedup by a log-template tree, DataFrame functions only.

A line is cut into pieces: before and after each sentence of SENTENCE words and more, so a passage gives the same pieces
wherever in a line it stands. A piece is parsed to a fixed depth: its number of tokens, its leading tokens (a third, and LEAD at
least where it has SENTENCE tokens), then, SPLITS times, the token at the place where its leaf has the fewest different ones, so
that families of lines with one beginning part. Tokens that hold a digit are variable fields. A leaf of several shapes has a
template, the most frequent token at each position, and the shapes that differ from it in one position of OTHER at most (in one
at least) are lines of that template; all others stand for themselves. A shape recurs if two documents hold it, a template if
GENERAL do: its pieces stay in the first of them (the smallest id) and are dropped from all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

#: Words of a sentence that is a piece, and of a part of a line that counts; the least tokens that lead there, and of what a template generalises.
SENTENCE, LEAD = 8, 4
#: One position of so many may differ from a template.
OTHER = 5
#: How often a leaf is split by the place with the fewest tokens, if these are half as many as its shapes at most.
SPLITS = 2
#: Documents of a generalised template; those in which its shapes first and last occur are counted.
GENERAL = 3
#: A whole line under LEAD tokens says too little: it recurs if one in RARE of the documents has it, and FEW at least.
RARE, FEW = 500, 3
FIELD = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
LONG_SENTENCE = r"(?:\A|(?<=[.!?]) )(?:[^ ]*+(?<![.!?]) ){7,}+[^ ]++(?<=[.!?])(?= |\z)"
#: Bits of a sieve; it is sent to all tasks in words of 64 bits, so it has at most SIEVE / 64 rows whatever went in.
SIEVE = 1 << 25


def sieve(keys: DataFrame, key: Column) -> DataFrame:
    """Words of a bitmap of the hashes of key: at most SIEVE / 64 rows."""
    bit = F.pmod(F.xxhash64(key), F.lit(SIEVE))
    return keys.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(b & 63 AS INT))")).alias("__bits"))


def sieved(df: DataFrame, key: Column, words: DataFrame, how: str = "inner") -> DataFrame:
    """df where key may be among the sieve's; with how left, all of df with __may."""
    bit = F.pmod(F.xxhash64(key), F.lit(SIEVE))
    met = df.withColumn("__bit", bit).join(F.broadcast(words), F.shiftright("__bit", 6) == F.col("__word"), how)
    may = F.coalesce(F.expr("(shiftright(__bits, CAST(__bit & 63 AS INT)) & 1) = 1"), F.lit(False))
    return (met.withColumn("__may", may) if how == "left" else met.filter(may)).drop("__bit", "__word", "__bits")


def token_count(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "))) + F.lit(1)


def masked(line: Column) -> Column:
    """The shape of a piece: fields for tokens that hold a digit, where a letter is left outside of them; no spaces around."""
    line = F.trim(line)
    shape = F.regexp_replace(line, FIELD, "<*>")
    return F.when(line.rlike("[0-9]"), F.when(shape.rlike(r"\p{L}"), shape).otherwise(line)).otherwise(line)


def pieces(line: Column) -> Column:
    """The pieces of a line, spaces between them included; of an empty line, one."""
    cut = F.filter(F.split(F.regexp_replace(line, LONG_SENTENCE, "\n$0\n"), "\n"), lambda p: p != "")
    return F.when(line == "", F.array(F.lit(""))).otherwise(cut)


def counts_as(shape: Column, whole: Column) -> Column:
    """Whether a piece can recur: not blank, and a whole line or SENTENCE tokens long."""
    return (shape != "") & (whole | (token_count(shape) >= SENTENCE))


def _holds(ordered: Column, steps: Column, value: Column) -> Column:
    """Whether a sorted array holds value, by halving; steps are the powers of two up to its size, falling."""
    last = F.aggregate(steps, F.lit(0), lambda t, s: F.when((t + s <= F.size(ordered)) & (F.get(ordered, t + s - 1) <= value), t + s).otherwise(t))
    return F.coalesce(F.get(ordered, last - 1) == value, F.lit(False))


def parsed(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with __parts in place of the text: for each line its pieces in order, each with the hash of its shape where it can recur, and
    the shape where that is not the piece without spaces around. The pieces of a line put together are the line, so the text is parsed only once."""

    def part(p: Column, whole: Column) -> Column:
        told = lambda s: F.struct(p.alias("piece"), F.when(counts_as(s, whole), F.xxhash64(s)).alias("line"), F.when(s != F.trim(p), s).alias("shape"))
        return F.get(F.transform(F.array(masked(p)), told), F.lit(0))

    parts = lambda ps: F.transform(ps, lambda p: part(p, F.size(ps) == 1))
    lines = F.transform(F.split(F.col(text_col), "\n"), lambda line: F.get(F.transform(F.array(pieces(line)), parts), F.lit(0)))
    return docs.withColumn("__parts", lines).drop(text_col)


def places(mixed: DataFrame) -> DataFrame:
    """leaf, pos, token, c: how many shapes of a leaf have the token there."""
    return mixed.select("leaf", F.posexplode("tokens").alias("pos", "token")).groupBy("leaf", "pos", "token").agg(F.count("*").alias("c"))


def split(mixed: DataFrame) -> DataFrame:
    """mixed with its leaves split by the token at the place that has the fewest, where several shapes share each on average."""
    at = places(mixed).groupBy("leaf", "pos").agg(F.count("*").alias("kinds"), F.sum("c").alias("shapes")).filter("kinds > 1 AND kinds * 2 <= shapes")
    chosen = at.groupBy("leaf").agg(F.min(F.struct("kinds", "pos"))["pos"].alias("at"))
    leaf = F.when(F.col("at").isNull(), F.col("leaf")).otherwise(F.xxhash64("leaf", F.get("tokens", F.col("at"))))
    return mixed.join(chosen, "leaf", "left").withColumn("leaf", leaf).drop("at")


def recurring_shapes(rows: DataFrame, texts_of, documents: int) -> DataFrame:
    """rows(id, line, leaf, n) -> (line, first_id): the shapes that recur by themselves or by their leaf's template, with the
    document in which they stay. texts_of gives (line, shape) of a table (line, id), which holds each line once."""
    shapes = written(rows.groupBy("leaf", "line", "n").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")), "shapes")
    short = rows.filter(F.col("n") < LEAD).groupBy("line", "id").count().groupBy("line").agg(F.count("*").alias("documents"))
    often = short.filter((F.col("documents") >= FEW) & (F.col("documents") * RARE >= documents)).select("line")
    exact = shapes.filter("first_id < last_id")
    alone = exact.filter(F.col("n") >= LEAD).unionByName(exact.filter(F.col("n") < LEAD).join(often, "line", "left_semi")).select("line", "first_id")

    several = written(shapes.groupBy("leaf").agg(F.count("*").alias("shapes"), F.min("first_id").alias("f"), F.max("last_id").alias("l")).filter("shapes > 1 AND f < l").select("leaf"), "several")
    few = written(sieved(shapes, F.col("leaf"), sieve(several, F.col("leaf"))).join(several, "leaf"), "mixed")  # a semi join would be made before the sieve
    # of all rows of a shape, those of its first document; by themselves, so that the list's size decides whether they move
    texts = texts_of(few.select("line", F.col("first_id").alias("id")))
    mixed = few.join(texts, "line").select("leaf", "line", "n", "first_id", "last_id", F.split("shape", " ").alias("tokens"))
    for _ in range(SPLITS):
        mixed = written(split(mixed), "leaves")
    top = places(mixed).groupBy("leaf", "pos").agg(F.max(F.struct("c", "token"))["token"].alias("token"))
    template = top.groupBy("leaf").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("template"))
    same = F.size(F.filter(F.zip_with("tokens", "template", lambda x, y: x == y), lambda x: x))
    agreeing = written(mixed.join(template, "leaf").filter(F.col("n") - same <= F.greatest(F.lit(1), F.floor(F.col("n") / OTHER))).select("leaf", "line", "first_id", "last_id"), "agreeing")
    held = agreeing.select("leaf", F.explode(F.array("first_id", "last_id")).alias("id")).groupBy("leaf", "id").count().groupBy("leaf").agg(F.count("*").alias("documents"), F.min("id").alias("first_id"))
    alike = agreeing.select("leaf", "line").join(held.filter(F.col("documents") >= GENERAL), "leaf").select("line", "first_id")
    return written(alone.unionByName(alike).groupBy("line").agg(F.min("first_id").alias("first_id")), "recurring")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """docs with the recurring pieces taken out of its text column, and lines that lose all their pieces. With counts, lines,
    dropped_lines and dropped_pieces (of lines that stay) count them and stand in for columns of docs with these names.

    Rows are joined by id, so rows with one id are one document. A NULL text stays NULL, an empty one empty, a document whose
    lines all go becomes empty, and a document without an id keeps all its lines. Blank lines stay. An empty table gives no rows.
    """
    whole = written(parsed(docs, text_col), "parsed")
    known = whole.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode("__parts").alias("parts")).select("id", F.explode("parts").alias("p"))
    found = known.filter("p.line IS NOT NULL").select("id", F.col("p.line").alias("line"), F.coalesce("p.shape", F.trim("p.piece")).alias("shape"))
    once = lambda c, name: F.explode(F.array(c)).alias(name)  # noqa: E731  # a value that is used again and must not be computed again
    counted = found.select("id", "line", "shape", once(token_count(F.col("shape")), "n"))
    third = F.floor(F.col("n") / 3).cast("int")
    lead = F.call_function("substring_index", F.col("shape"), F.lit(" "), F.when(F.col("n") >= SENTENCE, F.greatest(F.lit(LEAD), third)).otherwise(third))
    leaf = F.when(F.col("n") >= LEAD, F.xxhash64("n", lead)).otherwise(F.col("line"))
    rows = written(counted.select("id", "line", leaf.alias("leaf"), "n"), "lines")
    texts_of = lambda asked: sieved(found, F.col("line"), sieve(asked, F.col("line"))).join(asked, ["line", "id"]).dropDuplicates(["line"]).select("line", "shape")
    recurring = recurring_shapes(rows, texts_of, whole.filter(F.col(id_col).isNotNull()).count())
    gone = written(rows.select("id", "line").join(recurring, "line").filter("id > first_id").groupBy("id").agg(F.sort_array(F.collect_set("line")).alias("__gone")), "gone")
    steps = F.filter(F.array(*[F.lit(1 << b) for b in range(30, -1, -1)]), lambda s: s <= F.size("__gone"))
    asked = gone.withColumn("__steps", steps).withColumnRenamed("id", "__gone_id")
    # texts of documents that lose nothing don't move
    may = sieved(whole, F.col(id_col), sieve(gone, F.col("id")), "left")
    moved = may.filter("__may").drop("__may")
    moved = moved.join(asked, F.col(id_col) == F.col("__gone_id"), "left")
    joined = moved.unionByName(may.filter("NOT __may").drop("__may"), allowMissingColumns=True)

    def kept(parts: Column) -> Column:
        goes = lambda p: p["line"].isNotNull() & _holds(F.col("__gone"), F.col("__steps"), p["line"])
        left = F.when(F.col("__gone").isNull(), parts).otherwise(F.filter(parts, lambda p: ~goes(p)))
        return F.struct(F.size(parts).alias("all"), left["piece"].alias("left"))

    out = joined.withColumn("__lines", F.transform("__parts", kept)).drop("__parts")
    left = F.filter("__lines", lambda x: F.size(x["left"]) > 0)
    shown = lambda x: F.when(x["all"] == F.size(x["left"]), F.array_join(x["left"], "")).otherwise(F.trim(F.array_join(x["left"], "")))
    text = F.array_join(F.transform(left, shown), "\n")
    new = [
        F.coalesce(F.size("__lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.size(F.filter("__lines", lambda x: F.size(x["left"]) == 0)), F.lit(0)).alias("dropped_lines"),
        F.coalesce(F.aggregate(F.transform(left, lambda x: x["all"] - F.size(x["left"])), F.lit(0), lambda a, x: a + x), F.lit(0)).alias("dropped_pieces"),
    ] if counts else []
    own = [c for c in docs.columns if not counts or c not in ("lines", "dropped_lines", "dropped_pieces")]
    return out.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in own], *new)


def op6_linededup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring(docs).select("doc_id", F.col("text").alias("kept_text"), "lines", "dropped_lines", "dropped_pieces")


OP6_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE doc_id IS NOT NULL),
cut AS (SELECT doc_id, pos, unnest(string_split(regexp_replace(line, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) AS sentence,
        unnest(range(len(string_split(regexp_replace(line, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))))) AS spot FROM l),
long AS (SELECT *, len(sentence) - len(replace(sentence, ' ', '')) >= 7 AND regexp_matches(sentence, '[.!?]$') AS own FROM cut),
edge AS (SELECT *, CASE WHEN own OR lag(own, 1, true) OVER (PARTITION BY doc_id, pos ORDER BY spot) THEN 1 ELSE 0 END AS begins FROM long),
runs AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id, pos ORDER BY spot) AS part FROM edge),
p AS (SELECT doc_id, pos, part, string_agg(sentence, ' ' ORDER BY spot) AS piece, count(*) OVER (PARTITION BY doc_id, pos) = 1 AS whole FROM runs GROUP BY doc_id, pos, part),
m AS (SELECT *, CASE WHEN regexp_matches(piece, '[0-9]') AND regexp_matches(regexp_replace(piece, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '\p{L}')
        THEN regexp_replace(trim(piece), '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g') ELSE trim(piece) END AS shape FROM p),
s AS (SELECT doc_id, pos, part, piece, shape, string_split(shape, ' ') AS t, len(string_split(shape, ' ')) AS n,
        shape <> '' AND (whole OR len(string_split(shape, ' ')) >= 8) AS counted FROM m),
e AS (SELECT shape, any_value(t) AS t, any_value(n) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id, count(DISTINCT doc_id) AS docs FROM s WHERE counted GROUP BY shape),
alone AS (SELECT shape, first_id FROM e WHERE first_id < last_id AND (n >= 4 OR (docs >= 3 AND docs * 500 >= (SELECT count(doc_id) FROM documents)))),
led AS (SELECT *, n || ' ' || array_to_string(t[1:CASE WHEN n >= 8 THEN greatest(4, n // 3) ELSE n // 3 END], ' ') AS leaf FROM e WHERE n >= 4),
m0 AS (SELECT led.* FROM led JOIN (SELECT leaf FROM led GROUP BY leaf HAVING count(*) > 1 AND min(first_id) < max(last_id)) x USING (leaf)),
k0 AS (SELECT leaf, pos, token, count(*) AS c FROM (SELECT leaf, unnest(t) AS token, unnest(range(n)) AS pos FROM m0) GROUP BY leaf, pos, token),
h0 AS (SELECT leaf, arg_min(pos, struct_pack(kinds := kinds, pos := pos)) AS spot FROM (SELECT leaf, pos, count(*) AS kinds, sum(c) AS shapes FROM k0 GROUP BY leaf, pos) WHERE kinds > 1 AND kinds * 2 <= shapes GROUP BY leaf),
m1 AS (SELECT m0.* REPLACE (CASE WHEN spot IS NULL THEN m0.leaf ELSE m0.leaf || chr(10) || t[spot + 1] END AS leaf) FROM m0 LEFT JOIN h0 ON m0.leaf = h0.leaf),
k1 AS (SELECT leaf, pos, token, count(*) AS c FROM (SELECT leaf, unnest(t) AS token, unnest(range(n)) AS pos FROM m1) GROUP BY leaf, pos, token),
h1 AS (SELECT leaf, arg_min(pos, struct_pack(kinds := kinds, pos := pos)) AS spot FROM (SELECT leaf, pos, count(*) AS kinds, sum(c) AS shapes FROM k1 GROUP BY leaf, pos) WHERE kinds > 1 AND kinds * 2 <= shapes GROUP BY leaf),
m2 AS (SELECT m1.* REPLACE (CASE WHEN spot IS NULL THEN m1.leaf ELSE m1.leaf || chr(10) || t[spot + 1] END AS leaf) FROM m1 LEFT JOIN h1 ON m1.leaf = h1.leaf),
k2 AS (SELECT leaf, shape, n, first_id, last_id, unnest(t) AS token, unnest(range(n)) AS pos FROM m2),
v AS (SELECT leaf, pos, arg_max(token, struct_pack(c := c, token := token)) AS token FROM (SELECT leaf, pos, token, count(*) AS c FROM k2 GROUP BY leaf, pos, token) GROUP BY leaf, pos),
a AS (SELECT leaf, shape, any_value(first_id) AS first_id, any_value(last_id) AS last_id FROM k2 JOIN v USING (leaf, pos, token) GROUP BY leaf, shape, n HAVING n - count(*) <= greatest(1, n // 5)),
r AS (SELECT leaf, min(id) AS first_id FROM (SELECT leaf, unnest([first_id, last_id]) AS id FROM a) GROUP BY leaf HAVING count(DISTINCT id) >= 3),
g AS (SELECT shape, min(first_id) AS first_id FROM (SELECT * FROM alone UNION ALL SELECT a.shape, r.first_id FROM a JOIN r USING (leaf)) GROUP BY shape),
w AS (SELECT s.doc_id, s.pos, string_agg(s.piece, ' ' ORDER BY s.part) FILTER (WHERE NOT (s.counted AND g.first_id IS NOT NULL AND s.doc_id > g.first_id)) AS line,
        count(*) FILTER (WHERE s.counted AND s.doc_id > g.first_id) AS gone, count(*) AS parts FROM s LEFT JOIN g USING (shape) GROUP BY s.doc_id, s.pos),
d AS (SELECT doc_id, string_agg(CASE WHEN gone > 0 THEN trim(line) ELSE line END, chr(10) ORDER BY pos) FILTER (WHERE gone < parts) AS kept, count(*) AS lines,
        count(*) FILTER (WHERE gone = parts) AS dropped_lines, sum(CASE WHEN gone < parts THEN gone ELSE 0 END) AS dropped_pieces FROM w GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS kept_text, CAST(coalesce(lines, 0) AS INTEGER) AS lines,
  CAST(coalesce(dropped_lines, 0) AS INTEGER) AS dropped_lines, CAST(coalesce(dropped_pieces, 0) AS INTEGER) AS dropped_pieces
FROM documents LEFT JOIN d USING (doc_id)
"""
