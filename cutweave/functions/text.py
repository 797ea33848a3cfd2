"""What an instruction says: tokens, objects, destinations, actions and their kinds, as column expressions over arrays.

Arrays stand for sets: no word twice. describe() adds all of it in steps, so that nothing is computed more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as X

SPLIT = r"\b(?:" + "|".join(X.PLACES) + r")\b"


def words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(set(values))])


def without(a: Column, *lists: list[str]) -> Column:
    return F.array_except(a, words([w for x in lists for w in x]))


def within(a: Column, values: list[str]) -> Column:
    return F.array_intersect(a, words(values))


def some(a: Column) -> Column:
    return F.size(a) > 0


def only(a: Column, values: list[str]) -> Column:
    """Whether all words of a are among values."""
    return F.size(without(a, values)) == 0


def both(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def has(a: Column, values: list[str]) -> Column:
    return F.arrays_overlap(a, words(values))


def singular(t: Column) -> Column:
    cut = lambda n: F.left(t, F.length(t) - n)
    return F.when((F.length(t) > 4) & t.endswith("ies"), F.concat(cut(3), F.lit("y"))).when((F.length(t) > 3) & (t.endswith("ls") | (t.endswith("s") & ~t.endswith("ss"))), cut(1)).otherwise(t)


def tokens(text: Column) -> Column:
    """Singular lower-case tokens in order, repeats included."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), singular)


def similarity(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 if either is empty."""
    return F.when(some(a) & some(b), F.size(both(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def distinct_markers(a: Column, b: Column) -> Column:
    """Whether two sets of ordinals differ."""
    return F.when(some(a) | some(b), F.size(F.array_union(a, b)) > F.size(both(a, b))).otherwise(False)  # most texts have none


def described(df: DataFrame, text: str = "instruction", prefix: str = "") -> DataFrame:
    """df with the columns below, each with the prefix before its name. A NULL text has NULL for all.

    tokens, all_words, head (the first two tokens), primary (objects before the first place word), dest, dest_food, dest_focus (words
    after it), ingredients, subject, reference, focus, actions, families, markers (ordinals); specificity; and whether it is
    generic, prep_like, filler, specific, or has a recipe, prep_ingredient or mixing action or a phase_noun.
    """
    p, c = prefix, lambda name: F.col(f"{prefix}{name}")
    low = F.lower(F.col(text))
    at = F.split(low, SPLIT, 2)
    tail = F.when(F.size(at) > 1, tokens(F.get(at, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    out = df.withColumns({f"{p}tokens": tokens(F.col(text)), f"{p}__front": tokens(F.get(at, F.lit(0))), f"{p}__tail": tail})
    out = out.withColumns({
        f"{p}all_words": F.array_distinct(c("tokens")), f"{p}head": F.array_distinct(F.slice(c("tokens"), 1, 2)), f"{p}primary": without(c("__front"), X.COMMON),
        f"{p}dest": without(c("__tail"), X.COMMON, X.FILLER), f"{p}dest_food": without(c("__tail"), X.COMMON, X.FILLER, X.CONTAINER, X.FOOD_SKIP),
    }).drop(f"{p}__front", f"{p}__tail")
    base = without(c("primary"), X.CONTAINER, X.PREP_INGREDIENT, X.RECIPE, X.INGREDIENT_SKIP)
    scallion = F.when(F.array_contains(base, "scallion"), F.array_union(base, words(["green", "onion"]))).when(F.array_contains(base, "green") & F.array_contains(base, "onion"), F.array_union(base, words(["scallion"]))).otherwise(base)
    bare = [w for w in X.CONTAINER if w not in X.DISH]
    out = out.withColumns({
        f"{p}ingredients": scallion, f"{p}dest_focus": without(c("dest"), bare, X.DOING, X.REFERENCE, X.SEASONING), f"{p}subject": without(c("primary"), X.DOING, X.REFERENCE, X.SEASONING),
        f"{p}reference": within(without(c("primary"), X.DOING, X.SEASONING), X.REFERENCE), f"{p}actions": within(c("head"), [*X.RECIPE, *X.PREP_INGREDIENT, *X.MIXING, *X.STRONG]),
        f"{p}markers": within(c("all_words"), X.ORDER), f"{p}recipe": has(c("head"), X.RECIPE), f"{p}prep_ingredient": has(c("head"), X.PREP_INGREDIENT), f"{p}mixing": has(c("head"), X.MIXING),
        f"{p}phase_noun": has(c("all_words"), X.PHASE_NOUN), f"{p}prep_like": has(c("head"), X.PREP), f"{p}__filler": has(c("all_words"), X.FILLER),
    })
    n = lambda values: F.size(within(c("head"), values))
    starts = F.trim(low).rlike("^(" + "|".join(X.FILLER_STARTS) + ")")
    objects = without(F.array_union(c("ingredients"), without(c("primary"), X.CONTAINER)), X.DOING, X.REFERENCE)
    out = out.withColumns({
        f"{p}families": F.array_sort(F.array_compact(F.array(*[F.when(has(c("actions"), v), F.lit(k)) for k, v in X.FAMILIES.items()]))),
        f"{p}specificity": F.when(c("__filler"), -3).when(c("prep_like"), -2).otherwise(2 * n(X.STRONG) + 2 * n(X.MIXING) - n(X.GENERIC) - n(X.PREP_INGREDIENT)),
        f"{p}generic": c("__filler") | c("prep_like") | (n(X.GENERIC) >= F.greatest(F.lit(1), n(X.STRONG))), f"{p}filler": starts | c("__filler"), f"{p}__objects": objects,
    })
    plain = F.array_union(without(c("__objects"), X.ADDITIVE), c("dest_food"))
    focus = (
        F.when(some(c("dest_food")) & only(c("__objects"), X.ADDITIVE), c("dest_food"))
        .when(some(c("dest_focus")) & only(plain, X.SEASONING), F.array_union(without(plain, X.SEASONING), c("dest_focus")))
        .when(some(c("subject")) & only(plain, X.SEASONING), F.array_union(without(plain, X.SEASONING), c("subject")))
        .otherwise(plain)
    )
    return out.withColumns({f"{p}focus": focus, f"{p}specific": ~(c("generic") | c("prep_like") | c("filler"))}).drop(f"{p}__filler", f"{p}__objects")


def drifts(l: str, r: str, c=F.col) -> Column:  # noqa: E741
    """Whether two described texts, by their prefixes, tell of different tasks: other kinds of action, or nothing shared in focus or objects.
    c looks up their columns."""
    a, b = lambda n: c(f"{l}{n}"), lambda n: c(f"{r}{n}")
    apart = lambda x, y: some(x) & some(y) & ~some(both(x, y))
    left, right = without(a("primary"), X.CONTAINER), without(b("primary"), X.CONTAINER)
    # one after the other: sets are dear to compare
    return F.when(a("families") != b("families"), True).when(apart(a("focus"), b("focus")), True).otherwise(apart(left, right))


def key_of(text: Column) -> Column:
    """A text without case and spare white space."""
    return F.regexp_replace(F.trim(F.lower(text)), r"\s+", " ")


def slug(text: Column, most: int = 48) -> Column:
    """Lower-case letters and digits joined by underscores, at most most of them; segment if nothing is left."""
    joined = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.left(joined, F.lit(most)), F.lit("")), F.lit("segment"))


def safe_token(text: Column, fallback: str) -> Column:
    """A file name part: other characters become underscores, outer marks go."""
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(F.trim(text), "[^A-Za-z0-9._-]+", "_"), F.lit("._-")), F.lit("")), F.lit(fallback))


def escaped(text: Column, marks: str = "\\:'[],") -> Column:
    """A backslash before each of the marks, the backslash itself first."""
    for m in marks:
        text = F.replace(text, F.lit(m), F.lit("\\" + m))
    return text
