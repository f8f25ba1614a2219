"""Spelling variants: words one edit apart, found through an index of variable-length grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.session import staged

#: A gram has at least and at most so many code points, the end mark included. Words have MAX_GRAM + 1
#: code points or more, so that one edit always leaves a gram of them as it is.
MIN_GRAM, MAX_GRAM = 2, 5
#: At most so many grams of each length are frequent, so the dictionary has a proven size at any number of words.
MOST_FREQUENT = 4096
#: Stands after the last letter of a word; no word holds it.
END = "$"
#: Distinct words that a worker counts before it hands them on.
COUNTED = 200_000


def word_counts(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5,
    alter: Callable[[str, str], str] | None = None,
) -> DataFrame:
    """``word`` and ``n`` (occurrences) of the words of at least ``least_length`` code points and ``least_count`` occurrences.

    A word is a maximal run of Latin letters (A-Z, a-z, U+00C0 to U+00FF), with A-Z lower-cased. ``alter`` maps
    the key of the document (as text; null: empty) and a run to the word that is counted; it may shorten a run,
    never lengthen it. Null texts have no words. Counts are added up per task before the shuffle.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for part in batches:
            for doc, body in zip(part["doc"], part["body"]):
                # Only bytes lower-case A-Z alone.
                found = runs.findall(body.encode().lower().decode())
                if alter is None:
                    total.update(found)
                else:
                    for run, n in Counter(found).items():
                        total[alter(doc, run)] += n
                if len(total) > COUNTED:
                    yield pd.DataFrame(total.items(), columns=["word", "n"])
                    total.clear()
        yield pd.DataFrame(total.items(), columns=["word", "n"])

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"), F.coalesce(text, F.lit("")).alias("body"))
    counted = rows.mapInPandas(count, "word string, n long").filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def frequent_grams(words: DataFrame) -> frozenset[str]:
    """The grams too frequent to stay as they are: of each length below ``MAX_GRAM``, those that hold more than
    one in ``MOST_FREQUENT`` of all grams of that length."""
    marked = words.select(F.concat("word", F.lit(END)).alias("w"))
    lengths = F.array(*[F.lit(q) for q in range(MIN_GRAM, MAX_GRAM)])
    places = marked.select("w", F.explode(lengths).alias("q")).filter(F.length("w") >= F.col("q"))
    grams = places.select("q", F.explode(F.expr("transform(sequence(1, length(w) - q + 1), p -> substring(w, p, q))")).alias("gram"))
    counts = staged(grams.groupBy("q", "gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    totals = counts.groupBy("q").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "q").filter(F.col("n") * MOST_FREQUENT > F.col("total"))  # a row per length
    return frozenset(r.gram for r in kept.select("gram").collect())


def decompose(word: str, frequent: frozenset[str]) -> list[str]:
    """The gram that starts at each code point: ``MIN_GRAM`` code points, lengthened while it is frequent."""
    marked, grams = word + END, []
    for p in range(len(word)):
        end = p + MIN_GRAM
        while end < len(marked) and end < p + MAX_GRAM and marked[p:end] in frequent:
            end += 1
        grams.append(marked[p:end])
    return grams


def affected(grams: list[str]) -> int:
    """The most grams that one edit can change: those that cover one code point.

    How far a gram reaches depends on its own code points alone, so a gram that does not cover the edit
    stands in both words. An insertion changes only grams that cover both its neighbours.
    """
    starts = [0] * (len(grams) + MAX_GRAM + 1)
    for p, gram in enumerate(grams):
        starts[p] += 1
        starts[p + len(gram)] -= 1
    most = now = 0
    for change in starts[: len(grams)]:
        now += change
        most = max(most, now)
    return most


def gram_index(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """``word``, ``n``, ``size`` and per word the ``gram`` and place ``pos`` of its rarest grams, one more than an edit can change.

    Of two words one edit apart, the rarest gram that the edit leaves alone is in both selections: fewer grams
    than are selected can come before it in either word.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT grams a length

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            grams = [decompose(w, shared.value) for w in part["word"]]
            yield part.assign(grams=grams, lists=[affected(g) + 1 for g in grams])

    cut_words = staged(words.mapInPandas(cut, "word string, n long, grams array<string>, lists int"), "grams")
    places = cut_words.select("word", F.posexplode("grams").alias("pos", "gram"))
    lists = places.groupBy("gram").agg(F.count(F.lit(1)).alias("length"))
    ranked = places.join(lists, "gram").groupBy("word").agg(F.sort_array(F.collect_list(F.struct("length", "gram", "pos"))).alias("g"))
    chosen = cut_words.select("word", "n", "lists").join(ranked, "word")
    return chosen.select("word", "n", F.length("word").alias("size"), F.explode(F.slice("g", F.lit(1), F.col("lists"))).alias("g")).select(
        "word", "n", "size", "g.gram", "g.pos")


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of ``words`` (``word``, ``n``) that differ by one inserted, deleted or replaced code point: ``a``, ``na``, ``b``, ``nb``, once each.

    A gram that an edit leaves alone keeps its place in words of equal length, and keeps it or moves by one in
    a longer word; so gram, place and length together are the key under which words meet.
    """
    index = staged(gram_index(words, frequent_grams(words)), "gram-index")
    shifts = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in ((0, 0), (0, 1), (1, 1))])
    probes = index.select("word", "n", "gram", F.col("pos"), "size", F.explode(shifts).alias("shift")).select(
        F.col("word").alias("a"), F.col("n").alias("na"), "gram", (F.col("pos") + F.col("shift.p")).alias("pos"),
        (F.col("size") + F.col("shift.s")).alias("size"), (F.col("shift.s") == 0).alias("even"))
    met = probes.join(index.withColumnsRenamed({"word": "b", "n": "nb"}), ["gram", "pos", "size"])
    near = met.filter(~F.col("even") | (F.col("a") < F.col("b"))).filter(F.levenshtein("a", "b", 1) == 1)
    return near.select("a", "na", "b", "nb").distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for all rows (``word``, ``form``): the form of the form and so on, by pointer doubling.

    The chains must end; here each form is several times as frequent as the word before it.
    """
    roots = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.filter("moved").isEmpty():
        further = roots.select(F.col("word").alias("w"), F.col("root").alias("further"))
        roots = staged(
            roots.join(further, F.col("root") == F.col("w"), "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return roots.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Every row of ``words`` (``word``, ``n``) with its ``form``, ``root``, ``n_near`` and ``form_n``.

    ``form`` is the near word (one edit apart) of the largest count (ties: the smallest by code points) if that
    is at least ``ratio`` (2 or more) times the word's own, else null; ``root`` is the last of the forms that follow
    from it, the word itself if it has none; ``n_near`` counts its near words. Every pair is found: the index
    only leaves out words that cannot be one edit apart. Words must be distinct, without nulls, of more than
    ``MAX_GRAM`` code points and without the end mark; an empty table gives an empty result.
    """
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionAll(
        pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("k"), "other")).alias("top"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.k") >= ratio * F.col("n"), F.col("top")).alias("top"))
    found = staged(found.select("word", "n", "n_near", F.col("top.other").alias("form"), (-F.col("top.k")).alias("form_n")), "forms")
    roots = roots_of(found.filter(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
