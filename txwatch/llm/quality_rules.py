"""Quality rules: counts per document and divergence from language references.

Main path is DataFrame expressions only.  Each document is one row from scan to verdict;
no word ever leaves its row except in the corpus-wide word count.

* Base rules: too few words, or too many words inside repeated 5-word windows.
* Method: the histogram of character classes and the histogram of the language's most
  common words (of any length) are compared with the reference of the document's language (totals over
  all documents of that language) by the Jensen-Shannon distance (base 2, 0 to 1).
  Minimum lengths guard both: short texts have noisy histograms and are not judged.

Null text: no words, so ``base_failed``.  Null ``lang`` is a language of its own.  Repeated
rows are judged each; an empty table gives no rows; further columns are ignored.  Equal
counts of common words are ranked by the word.  A very long text is one row: its window
hashes are sorted in place, so the work grows with n log n of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import staged, whole_row, words_of

#: Base rule of the contract (fixed values).
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Method parameters.
COMMON_WORDS = 20          # words in a language's reference histogram
MIN_CHARS = 200            # below: character classes are not judged
MIN_JUDGED_WORDS = 60      # below: common words are not judged
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.36
NO_LANG = "\x00none"
BROADCAST_LANGS = 10_000   # rows of a few hundred bytes each: some MB at most

CLASSES = ("lower", "space", "upper", "digit", "point", "letter", "other")


def twin_positions(df: DataFrame) -> DataFrame:
    """``q_at``: positions of the hashes in ``q_gram`` that occur there more than once, in
    order.  ``q_bits``: bits that hold any position.

    Position and hash share one long, so that a sort of primitives brings equal hashes
    together; that cuts the top bits off the hash.  Where two different hashes then share
    what is left (neighbours after the sort), whole hashes are sorted with their positions.
    """
    df = df.withColumn("q_sort", F.sort_array(F.transform(
        "q_gram", lambda h, i: F.call_function("shiftleft", h, F.col("q_bits")).bitwiseOR(i.cast("long")))))
    df = df.withColumn("q_mask", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("q_bits")) - 1)

    def gram_at(packed: Column) -> Column:
        return F.get(F.col("q_gram"), packed.bitwiseAND(F.col("q_mask")).cast("int"))

    def cut(packed: Column) -> Column:
        return F.call_function("shiftrightunsigned", packed, F.col("q_bits"))

    def clash(x: Column, i: Column) -> Column:
        after = F.get(F.col("q_sort"), i + 1)
        return F.coalesce((cut(x) == cut(after)) & (gram_at(x) != gram_at(after)), F.lit(False))

    def twin(x: Column, i: Column) -> Column:
        mine = gram_at(x)
        return (F.coalesce(mine == gram_at(F.get(F.col("q_sort"), i - 1)), F.lit(False))
                | F.coalesce(mine == gram_at(F.get(F.col("q_sort"), i + 1)), F.lit(False)))

    df = df.withColumn("q_clash", F.exists(F.transform("q_sort", clash), lambda x: x))
    df = df.withColumn("q_whole", F.when(F.col("q_clash"), F.sort_array(F.transform(
        "q_gram", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))))

    def whole_twin(x: Column, i: Column) -> Column:
        return (F.coalesce(x["h"] == F.get(F.col("q_whole"), i - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(F.col("q_whole"), i + 1)["h"], F.lit(False)))

    return df.withColumn("q_at", F.sort_array(
        F.when(F.col("q_clash"), F.transform(F.filter("q_whole", whole_twin), lambda x: x["i"]))
        .otherwise(F.transform(F.filter("q_sort", twin), lambda x: x.bitwiseAND(F.col("q_mask"))))))


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus words and the contract's counts (columns prefixed ``q_``)."""
    text = F.col("text")
    df = docs.withColumn("q_words", words_of(text)).withColumn("q_n", F.size("q_words"))
    # 5-word windows as 64-bit hashes; position packed below the hash so that one sort of
    # primitive longs brings equal windows together
    df = df.withColumn("q_hash", F.transform("q_words", lambda x: F.xxhash64(x)))
    h = lambda i, k: F.get(F.col("q_hash"), i + k)
    df = df.withColumn("q_gram", F.when(
        F.col("q_n") > WINDOW,
        F.slice(F.transform("q_hash", lambda x, i: F.xxhash64(x, *[h(i, k) for k in range(1, WINDOW)])),
                F.lit(1), F.greatest(F.col("q_n") - (WINDOW - 1), F.lit(0)))))
    # most documents repeat no window: one hash set tells, and only the others are sorted
    df = df.withColumn("q_gram", F.when(F.size(F.array_distinct("q_gram")) < F.size("q_gram"), F.col("q_gram")))
    df = df.withColumn("q_bits", F.length(F.bin(F.col("q_n"))))
    df = twin_positions(df)
    df = df.withColumn("q_repeat", F.coalesce(F.aggregate(
        F.transform("q_at", lambda p, i: F.least(
            F.lit(WINDOW).cast("long"), F.coalesce(F.get(F.col("q_at"), i + 1) - p, F.lit(WINDOW).cast("long")))),
        F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return (df
            .withColumn("q_lines", lines)
            .withColumn("q_dup_lines", F.coalesce(F.size("q_lines") - F.size(F.array_distinct("q_lines")), F.lit(0)))
            .drop("q_gram", "q_sort", "q_at", "q_lines", "q_bits", "q_mask", "q_clash", "q_whole"))


def _class_counts(df: DataFrame) -> DataFrame:
    """``q_classes``: characters of each class.  Each pass strips one class and hands the
    shorter rest on, so the later passes read little."""
    rest = "text"
    names = []
    for k, pattern in enumerate(("[a-z]+", "[ \\t-\\r]+", "[A-Z]+", "[0-9]+", "[.,;:!?'\"()-]+", "\\p{L}+")):
        df = df.withColumn(f"q_r{k}", F.regexp_replace(F.coalesce(F.col(rest), F.lit("")), pattern, ""))
        rest = f"q_r{k}"
        names.append(rest)
    sizes = [F.length(F.coalesce(F.col("text"), F.lit("")))] + [F.length(c) for c in names] + [F.lit(0)]
    counts = [(sizes[k] - sizes[k + 1]).cast("long") for k in range(len(CLASSES))]
    symbols = F.length("q_r3") - F.length(F.regexp_replace("q_r3", "[#*$%&|<>]+", ""))
    return (df.withColumn("q_classes", F.array(*counts)).withColumn("q_symbols", symbols)
            .withColumn("q_word_chars", sizes[0] - counts[1]).drop(*names))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two count arrays."""
    def share(a: Column) -> Column:
        total = F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
        return F.transform(a, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))

    def part(x: Column, y: Column) -> Column:
        m = (x + y) / 2
        return (F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
                + F.when(y > 0, y * F.log2(y / m)).otherwise(F.lit(0.0))) / 2

    parts = F.zip_with(share(p), share(q), part)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def common_words(docs: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """The ``k`` most frequent words of each language over all documents (ties: by word).

    Counts are combined in the task before the shuffle, so a frequent word is one row a task.
    """
    counts = (docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("q_lang"),
                          F.explode(words_of(F.col("text"))).alias("q_word"))
              .groupBy("q_lang", "q_word").count())
    rank = Window.partitionBy("q_lang").orderBy(F.desc("count"), "q_word")
    return (counts.withColumn("q_rank", F.row_number().over(rank)).where(F.col("q_rank") <= k)
            .groupBy("q_lang")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("q_rank", "q_word"))),
                             lambda x: x["q_word"]).alias("q_common")))


def _word_counts(df: DataFrame, k: int) -> DataFrame:
    """``q_hist``: occurrences of each common word of the language, then of all other words.

    Words become one letter each (their rank), so that counting a rank is a byte search
    over a short string.  ``k`` is at most 64, the letters below.
    """
    marks = [chr(48 + i) for i in range(k)]
    letter = F.array(F.lit(""), *[F.lit(m) for m in marks])
    df = df.withColumn("q_common", F.transform("q_common", lambda x: F.xxhash64(x)))
    df = df.withColumn("q_code", F.array_join(F.transform(
        "q_hash", lambda x: F.get(letter, F.array_position(F.col("q_common"), x).cast("int"))), ""))
    known = F.octet_length("q_code")
    hits = [(known - F.octet_length(F.replace(F.col("q_code"), F.lit(m), F.lit("")))).cast("long")
            for m in marks]
    return df.withColumn("q_hist", F.array(*hits, (F.col("q_n") - known).cast("long"))).drop("q_code")


def _sized(by_lang: DataFrame) -> DataFrame:
    """Marks a table of one row per language for broadcast where its count allows it."""
    return F.broadcast(by_lang) if by_lang.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS else by_lang


def features(docs: DataFrame, k: int = COMMON_WORDS, with_text: bool = False) -> DataFrame:
    """Counts and both histograms of each document; ``q_row`` holds its columns (without
    the text unless asked for).

    The references hold one row of ``k`` words per language.  While they are at most
    ``BROADCAST_LANGS`` rows (counted) they are broadcast, so no text moves; with more,
    Spark joins by shuffle and splits skewed languages.
    """
    if not 1 <= k <= 64:
        raise ValueError("k must be 1 to 64")
    common = _sized(staged(common_words(docs, k), "common"))
    df = docs.select(whole_row(docs, () if with_text else ("text",)).alias("q_row"), "text",
                     F.coalesce("lang", F.lit(NO_LANG)).alias("q_lang"))
    df = df.join(common, "q_lang", "left")
    df = df.withColumn("q_common", F.coalesce("q_common", F.array().cast("array<string>")))
    df = _word_counts(_class_counts(with_counts(df)), k)
    return df.withColumn("q_chars", F.coalesce(F.length("text"), F.lit(0))).drop(
        "q_words", "q_hash", "q_common", "text")


def references(feats: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """One row per language: totals of both histograms over all its documents."""
    sums = [F.sum(F.col("q_classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("q_hist")[i]).alias(f"h{i}") for i in range(k + 1)]
    out = feats.groupBy("q_lang").agg(*sums)
    return out.select("q_lang",
                      F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("q_ref_classes"),
                      F.array(*[f"h{i}" for i in range(k + 1)]).alias("q_ref_hist"))


def _verdicts(docs: DataFrame, k: int, with_text: bool) -> DataFrame:
    """Staged features plus base_failed, both distances (null where the document is too
    short to be judged) and kept.  The references are sums over the staged features."""
    feats = staged(features(docs, k, with_text), "quality")
    df = feats.join(_sized(references(feats, k)), "q_lang", "left")
    df = df.withColumn("q_class_distance", F.when(
        F.col("q_chars") >= MIN_CHARS, js_distance(F.col("q_classes"), F.col("q_ref_classes"))))
    df = df.withColumn("q_word_distance", F.when(
        F.col("q_n") >= MIN_JUDGED_WORDS, js_distance(F.col("q_hist"), F.col("q_ref_hist"))))
    base = (F.col("q_n") < MIN_WORDS) | (F.col("q_repeat") * 100 > F.col("q_n") * MAX_REPEAT_PERCENT)
    strange = ((F.coalesce("q_class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE)
               | (F.coalesce("q_word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE))
    return df.withColumn("q_base_failed", base).withColumn("q_kept", ~base & ~strange)


def judged(docs: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """Every row of ``docs`` without its text, with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long), base_failed, class_distance, word_distance, kept."""
    out = [F.col("q_n").cast("long").alias("n_words"), F.col("q_word_chars").cast("long").alias("word_chars"),
           F.col("q_symbols").cast("long").alias("n_symbols"), F.col("q_dup_lines").cast("long").alias("n_dup_lines"),
           F.col("q_repeat").alias("n_repeat_words"), F.col("q_base_failed").alias("base_failed"),
           F.col("q_class_distance").alias("class_distance"), F.col("q_word_distance").alias("word_distance"),
           F.col("q_kept").alias("kept")]
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "class_distance", "word_distance", "kept", "text"]
    keep = [F.col(f"q_row.`{c}`") for c in docs.columns if c not in own]
    return _verdicts(docs, k, with_text=False).select(*keep, *out)


def filtered(docs: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    return _verdicts(docs, k, with_text=True).where("q_kept").select("q_row.*")
