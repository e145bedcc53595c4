"""Quality rules: base counts, and divergence from language references.

Only DataFrame functions are used. A document's histogram of character classes and its
histogram of common words are compared with the histograms of its language by
Jensen-Shannon distance (base 2, so 0 to 1). The common words and the references of a
language come from all its documents that pass the base rules, so junk that these find
has no say in them. Short documents have noisy histograms; a minimum length guards each
comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queryset.llm.scratch import by_key, written

WORD = r"[^\x20\x09-\x0D]+"
#: A lower-case word with a character of ASCII that is no letter can't be a common word.
NO_LETTER = r"[\x00-\x60\x7B-\x7F]"


def _char_classes(text: Column, joined: Column) -> tuple[Column, Column]:
    """Code points by class: a-z, white space, A-Z, beyond ASCII, digits, other marks; and the marks. ``joined`` is the text without white space; each step removes one class."""
    rest, out = joined, []
    for pattern in ("[a-z]+", "[A-Z]+", r"[^\x00-\x7F]+", "[0-9]+"):
        shorter = F.regexp_replace(rest, pattern, "")
        out.append(F.char_length(rest) - F.char_length(shorter))
        rest = shorter
    out.insert(1, F.char_length(text) - F.char_length(joined))
    return F.array(*out, F.char_length(rest)).cast("array<long>"), rest


def _window_hashes(words: Column) -> Column:
    """A hash of each 3-word window, in their order. Null below four words."""
    n = F.size(words) - 2
    parts = [F.slice(words, k + 1, n).alias(name) for k, name in enumerate("abc")]
    return F.when(n > 1, F.transform(F.arrays_zip(*parts), lambda x: F.xxhash64(x["a"], x["b"], x["c"])))


def _equal_neighbours(ordered: Column, fields: str) -> Column:
    """Starts (field ``at``) of the entries that equal a neighbour in these fields, ascending."""
    pairs = F.arrays_zip(ordered.alias("x"), F.slice(ordered, 2, F.size(ordered)).alias("y"))
    same = F.filter(pairs, lambda p: reduce(lambda a, b: a & b, (p["x"][f] == p["y"][f] for f in fields)))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(same, lambda p: F.array(p["x"]["at"], p["y"]["at"])))))


def _by_hash(hashes: Column) -> Column:
    """Hashes with their starts in the order of hashes. Null where all differ, as all windows do then."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("at"))))


def _sorted_windows(words: Column, starts: Column) -> Column:
    """The windows at these starts in the order of their words; equal windows are neighbours."""
    return F.sort_array(F.transform(starts, lambda at: F.struct(*(F.get(words, at + k).alias(name) for k, name in enumerate("abc")), at.alias("at"))))


def _covered(starts: Column, width: int = 3) -> Column:
    """Words under windows of ``width`` words at these ascending starts."""
    steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda x, y: F.least(F.coalesce(y - x, F.lit(width)), F.lit(width)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts of every document, beside its language (null: the empty string) and its lower-case words joined by one space."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("language"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("joined", F.array_join("words", "")).withColumn("hashes", _window_hashes(F.col("words")))
    # Only windows whose hash occurs twice are compared by their words.
    rows = rows.withColumn("hashes", _by_hash(F.col("hashes")))
    chars, marks = _char_classes(F.col("text"), F.col("joined"))
    rows = rows.select(
        "doc_id",
        "language",
        F.lower(F.array_join("words", " ")).alias("lowered"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length("joined").cast("long").alias("word_chars"),
        F.regexp_count(marks, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        chars.alias("chars"),
        _sorted_windows(F.col("words"), _equal_neighbours(F.col("hashes"), "h")).alias("windows"),
    )
    rows = rows.withColumn("starts", _equal_neighbours(F.col("windows"), "cba"))
    return rows.select(
        "doc_id",
        "language",
        "lowered",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0).cast("long")).alias("n_repeat_words"),
        "chars",
    )


def common_words(found: DataFrame, n_common: int) -> DataFrame:
    """``language, docs, listed``: each language's ``n_common`` most frequent words of letters over all its base-passing documents.

    Counts are combined before the shuffle, and each task hands on no more than
    ``n_common`` words a language, so a language may hold any share of the corpus. Of
    equally frequent words the least comes first. A language without such words has an
    empty list.
    """
    counts = found.where(~F.col("base_failed")).select("language", F.explode(F.split("lowered", " ")).alias("word")).groupBy("language", "word").agg(F.count("*").alias("n"))
    first = Window.partitionBy("language").orderBy(F.desc("n"), "word")
    top = counts.where((F.col("word") != "") & ~F.col("word").rlike(NO_LETTER)).withColumn("at", F.row_number().over(first)).where(F.col("at") <= n_common)
    lists = top.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("at", "word")))["word"].alias("listed"))
    docs = found.groupBy("language").agg(F.count("*").alias("docs"))
    return docs.join(lists, "language", "left").select("language", "docs", F.coalesce("listed", F.array().cast("array<string>")).alias("listed"))


def with_common(found: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds ``common``: occurrences of each common word of the document's language, then of all other words. The words go."""
    firsts = F.array_distinct(F.transform("listed", lambda w: F.left(w, F.lit(1))))
    rests = lambda c: F.transform(F.filter("listed", lambda w: F.left(w, F.lit(1)) == c), lambda w: F.substr(w, F.lit(2)))
    by_first = F.array_join(F.transform(firsts, lambda c: F.concat(c, F.lit("(?:"), F.array_join(rests(c), "|"), F.lit(")"))), "|")
    any_of = F.when(F.size("listed") > 0, F.concat(F.lit(" (?:"), by_first, F.lit(")(?= )"))).otherwise("(?!)")
    rows = by_key(found, lists.withColumn("any_of", any_of), "language", "docs")
    rows = rows.withColumn("hits", F.regexp_extract_all(F.concat(F.lit(" "), "lowered", F.lit(" ")), F.col("any_of"), F.lit(0)))
    counted = F.transform("listed", lambda w: (F.size("hits") - F.size(F.array_remove("hits", F.concat(F.lit(" "), w)))).cast("long"))
    return rows.withColumn("common", F.concat(counted, F.array(F.col("n_words") - F.size("hits")))).drop("lowered", "listed", "any_of", "docs", "hits")


def references(found: DataFrame, n_common: int) -> DataFrame:
    """``language, docs`` and histograms summed over its base-passing documents (null if it has none)."""
    n_chars, passed = 6, ~F.col("base_failed")
    summed = lambda name, k: F.sum(F.when(passed, F.get(name, F.lit(k))))
    sums = [summed("chars", k).alias(f"c{k}") for k in range(n_chars)] + [summed("common", k).alias(f"w{k}") for k in range(n_common + 1)]
    of = lambda letter, n: F.filter(F.array(*(f"{letter}{k}" for k in range(n))), lambda x: x.isNotNull())
    return found.groupBy("language").agg(F.count("*").alias("docs"), *sums).select("language", "docs", of("c", n_chars).alias("ref_chars"), of("w", n_common + 1).alias("ref_common"))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two count histograms; null where one of them is empty. Column ``n_`` before a histogram's name holds its sum."""
    n_p, n_q = F.col(f"n_{p}"), F.col(f"n_{q}")

    def part(x, y):
        a, b = x / n_p, y / n_q
        mean = (a + b) / 2
        return F.when(x > 0, a * F.log2(a / mean)).otherwise(0.0) + F.when(y > 0, b * F.log2(b / mean)).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda n, v: n + v) / 2
    return F.when((n_p > 0) & (n_q > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def with_totals(rows: DataFrame, *names: str) -> DataFrame:
    """Adds the sum of each histogram once; inside distance() it would be summed anew for each of its elements."""
    return rows.withColumns({f"n_{n}": F.aggregate(n, F.lit(0).cast("long"), lambda a, v: a + v) for n in names})


def judged(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, max_char_distance: float = 0.28, max_word_distance: float = 0.3, min_chars: int = 200, min_common_words: int = 100, n_common: int = 32) -> DataFrame:
    """One row per document with counts, distances, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent``
    of them inside repeated 3-word windows. ``kept``: not base_failed, and no guarded
    distance above its limit. A document with fewer than ``min_chars`` characters in words
    (``min_common_words`` words) has no say in the first (second) comparison, nor has one
    whose language has no document that passes the base rules.

    Null and empty texts have no words and fail; every value of the language has its own
    words and references, null and the empty string share them; repeated rows each keep
    their row and weigh in the references; other columns are ignored; an empty table gives
    no rows. Languages may be many: they are joined by key, hot ones by a bounded broadcast.
    """
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    found = written(features(docs).withColumn("base_failed", base), "rules")
    found = written(with_common(found, written(common_words(found, n_common), "common")), "histograms")
    named = ("chars", "common", "ref_chars", "ref_common")
    rows = with_totals(by_key(found, written(references(found, n_common), "references"), "language", "docs"), *named)
    rows = rows.withColumn("char_distance", F.when(F.col("word_chars") >= min_chars, distance("chars", "ref_chars")))
    rows = rows.withColumn("word_distance", F.when(F.col("n_words") >= min_common_words, distance("common", "ref_common")))
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance) | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).drop("docs", *named, *(f"n_{n}" for n in named))
