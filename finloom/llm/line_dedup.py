"""Line dedup: an exact set-similarity join over the lines of a corpus, in DataFrame and SQL functions only.

A line is the set of its lower-cased words. A later line goes when an earlier one (by ``doc_id``, then line
number) has a Jaccard similarity of at least ``threshold`` with it, whether that earlier line stays or not. Lines
without words are never removed, nor are those of fewer than ``min_words`` distinct words where a caller asks for it.

1. A word is one long: its length, long words first, then 57 bits of its hash. Long words are rare ones, mostly, and no
   pass over the corpus is needed to know them. ``counted`` orders words by their counts over the corpus instead,
   in ``RANKS`` hash buckets; the order decides how many candidates there are, not what is found.
2. Equal sets become one row with their first occurrence, so copies never meet each other in a join.
3. Similar sets share two neighbours in that order among their first ones (``prefix_sql``). Keys of one set
   go before the join, which keeps pairs whose sizes allow the similarity and 64 bits of parity, which bound their
   symmetric difference. Very long lines, which these can't tell apart, have 256 bits: these 64, and 192 more.
4. Pairs that the common words of their prefixes still allow are verified on their full word sets, which are read again
   for those lines alone.

A key of very many distinct sets (``HOT`` or more) makes no pairs: a semi join that holds the full words of its sets asks
for each whether any earlier one is similar, and stops at the first. Near copies by the thousand so cost a few comparisons
each; a set without a similar one still meets all sets of its key.

Defined cases: a null text stays null; blank lines stay; rows with one ``doc_id`` and one text are the same
document and fare alike; a null ``doc_id`` comes before all others; other columns pass through untouched.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.llm.common import Scratch, among, array_of, cut, fresh, settled, table

THRESHOLD = Fraction(4, 5)
MIN_WORDS = 1
RANKS = 1 << 18  # buckets, 2 MB of longs
HOT = 64  # sets of a key from which on it makes no pairs
PAIRS = Fraction(3, 4)  # least threshold at which similar sets surely share two neighbours
WIDE = 96  # words from which on a line has a wide parity
WIDE_BITS = (1, 2, 3)  # which words each long of it takes: those whose code has all these bits above the lowest six
SPLIT = "'[\\\\x09-\\\\x0D ]+'"


def pieces_sql(text: str, lower: str = "lower({})") -> str:
    # A split at one sign needs no pattern; it does where no white space but spaces and line ends is there.
    other = " or ".join(f"contains({text}, chr({sign}))" for sign in (9, 11, 12, 13))
    return f"split({lower.format(text)}, if({other}, {SPLIT}, ' '))"


def words_sql(text: str) -> str:
    return f"array_remove({pieces_sql(text, lower="replace(lower({}), chr(10), ' ')")}, '')"


def code_of(word: Column) -> Column:
    return F.shiftleft(-F.octet_length(word).cast("long"), 57).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 7))


def word_ranks(docs: DataFrame) -> DataFrame:
    """One row with ``RANKS`` longs: for each hash bucket of words the level of its count, in the bits above 58."""
    counted = (docs.select(F.explode(F.expr(words_sql("text"))).alias("w"))
               .select(F.expr(f"cast(xxhash64(w) & {RANKS - 1} as int)").alias("i"))
               .groupBy("i").agg(F.count("*").alias("n")))
    levels = counted.select("i", F.shiftleft(
        F.least(F.lit(31), F.floor(0.7 * F.log2(F.col("n") + 1))).cast("long"), 58).alias("v"))
    return array_of(levels, RANKS)


def overlap_sql(threshold: Fraction, a: str, b: str) -> str:
    """The number of common words that the similarity asks of sets of these sizes."""
    top, below = threshold.numerator, threshold.numerator + threshold.denominator
    return f"(({top} * ({a} + {b}) + {below - 1}) div {below})"


def lines_of(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def with_codes(lines: DataFrame, ranks: DataFrame | None) -> DataFrame:
    """The distinct words of each line as sorted codes, rare ones first."""
    if ranks is None:
        pieces = F.transform(F.expr(pieces_sql("line")), code_of)
        codes = F.array_except(pieces, F.array(code_of(F.lit(""))))
        return lines.withColumn("codes", settled(F.sort_array(codes))).drop("line")
    words = F.array_distinct(F.transform(F.expr(words_sql("line")), lambda w: F.xxhash64(w)))
    hashed = lines.withColumn("h", settled(words)).withColumn("numbers", ranks.scalar())
    codes = F.transform("h", lambda x: F.get("numbers", x.bitwiseAND(RANKS - 1).cast("int")).bitwiseOR(
        F.shiftrightunsigned(x, 6)))
    return hashed.withColumn("codes", settled(F.sort_array(codes))).drop("line", "numbers", "h")


def span_of(threshold: Fraction) -> int:
    """Words in a key."""
    return 2 if threshold >= PAIRS else 1


def prefix_sql(threshold: Fraction) -> str:
    """The number of first words that hold a common key of any two similar sets; none if no other set can be similar.

    One word: of n at least t * n are common. Two neighbours: each word of a set that the other lacks parts two pairs of
    its own and one of the other's. With c common words 2 * (n - c) + (m - c) pairs of the set of n are parted at most,
    which is 2 * (1 - t) * n or less, as c is t / (1 + t) * (n + m) or more and m is t * n or more. At t = 3/4 and above
    every set that can have a similar one has more pairs than that, so the first common pair is among those.
    """
    top, below = threshold.numerator, threshold.denominator
    words = (f"2 * {below - top} * n div {below} + 2" if span_of(threshold) == 2
             else f"n - ({top} * n + {below - 1}) div {below} + 1")
    return f"if(n * {below - top} >= {top}, {words}, 0)"


def set_lines(docs: DataFrame, ranks: DataFrame | None, threshold: Fraction, min_words: int) -> DataFrame:
    """The lines with words, with the 128-bit name of their set, its size, parity and prefix.

    A set so small that no other set can be similar has no prefix: it takes part by its name alone.
    """
    def bits(words: str) -> str:
        return f"aggregate({words}, 0L, (a, x) -> a ^ shiftleft(1L, cast(x & 63 as int)))"

    wide = ", ".join(f"'w{k}', {bits(f'filter(codes, x -> (x & {k << 6}) = {k << 6})')}" for k in WIDE_BITS)
    length = prefix_sql(threshold)
    return (with_codes(lines_of(docs), ranks).withColumn("n", F.size("codes"))
            .where(F.col("n") >= max(1, min_words))
            .select("doc_id", "row", "line_no", "n",
                    F.xxhash64("codes").alias("h1"), F.xxhash64(F.lit("second"), "codes").alias("h2"),
                    F.expr(bits("codes")).alias("parity"),
                    F.expr(f"if(n >= {WIDE}, named_struct({wide}), null)").alias("wide"),
                    F.expr(f"element_at(codes, cast(nullif({length}, 0) as int))").alias("last"),
                    F.expr(f"transform(slice(codes, 1, cast({length} as int)), x -> hash(x))").alias("prefix")))


def postings(sets: DataFrame, *more: str, span: int = 2) -> DataFrame:
    """A row for each key of a set, ``code``: a word, or two neighbours."""
    first = F.col("word").cast("long")
    second = F.get("prefix", F.col("pos") + 1).cast("long")
    code = first if span == 1 else F.shiftleft(first, 32).bitwiseOR(second.bitwiseAND(0xFFFFFFFF))
    return (sets.select("id", "n", "parity", "wide", *more, "prefix", F.posexplode("prefix").alias("pos", "word"))
            .where(F.col("pos") <= F.size("prefix") - span)
            .select("id", "n", "parity", "wide", *more, code.alias("code")))


def fits(threshold: Fraction) -> str:
    """Length and parity filters on a pair of postings ``a`` and ``b``.

    Wide parity is that of the words with both, with only one and with neither of two bits: four times 64 bits, made
    of ``parity`` and the three longs by exclusive or.
    """
    top, below = threshold.numerator, threshold.denominator
    need = overlap_sql(threshold, "a.n", "b.n")
    one, two, both = (f"a.wide.w{k} ^ b.wide.w{k}" for k in WIDE_BITS)
    apart = " + ".join(f"bit_count({bits})" for bits in (
        both, f"{one} ^ {both}", f"{two} ^ {both}", f"a.parity ^ b.parity ^ {one} ^ {two} ^ {both}"))
    return (f"a.n * {below} >= b.n * {top} and b.n * {below} >= a.n * {top}"
            f" and bit_count(a.parity ^ b.parity) <= a.n + b.n - 2 * {need}"
            f" and coalesce({apart}, 0) <= a.n + b.n - 2 * {need}")


def shared_postings(sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The postings of keys that two postings or more have, with their number, ``many``.

    Most keys are of one set. Only keys and ids are shuffled to see which; what the join asks for is fetched for the rest.
    """
    every = postings(sets, span=span_of(threshold)).select("code", "id")
    found = every.withColumn("many", F.count("*").over(Window.partitionBy("code"))).where("many > 1")
    return found.join(sets.select("id", "n", "parity", "wide"), "id")


def plausible(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs of sets (``a``, ``b``; written) whose prefixes allow the similarity: ``later``, ``earlier``, ``apart``.

    Of two sets take the one whose last prefix word is the rarer. What it has in common with the other up to that word
    lies in both prefixes; all it may share beyond is its other words. Prefixes hold 32 bits a word: a clash of two words in one prefix counts as one more common word.
    """
    need = overlap_sql(threshold, "x.n", "y.n")

    def most(end: str) -> str:
        return f"{end}.n - size(array_distinct({end}.prefix))"

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    ends = sets.where(among([sets["id"]], ids, ["id"])).select("id", F.struct("first", "n", "last", "prefix", "parity").alias("end"))
    return (pairs.join(ends.select(F.col("id").alias("a"), F.col("end").alias("x")), "a")
            .join(ends.select(F.col("id").alias("b"), F.col("end").alias("y")), "b")
            .where(f"size(array_intersect(x.prefix, y.prefix)) + if(x.last <= y.last, {most('x')}, {most('y')}) >= {need}")
            .select(F.when(F.col("x.first") > F.col("y.first"), F.col("a")).otherwise(F.col("b")).alias("later"),
                    F.when(F.col("x.first") > F.col("y.first"), F.col("b")).otherwise(F.col("a")).alias("earlier"),
                    F.bit_count(F.col("x.parity").bitwiseXOR(F.col("y.parity"))).alias("apart")))


def word_sets(ids: DataFrame, sets: DataFrame, docs: DataFrame, ranks: DataFrame | None, own: Scratch) -> DataFrame:
    """The full word sets of some ids, read again from the lines where they first occur."""
    wanted = own.cut(sets.join(ids.distinct(), "id", "left_semi").select("id", "first.*", "h1", "h2"), "lines-wanted")
    here = among([docs["doc_id"].cast("long"), F.xxhash64(docs["text"])], wanted, ["doc_id", "row"])
    lines = lines_of(docs.where(here))
    place = ["doc_id", "row", "line_no"]
    likely = lines.where(among([lines[c] for c in place], wanted, place))
    same = [likely[c].eqNullSafe(wanted[c]) for c in place]
    read = likely.join(wanted, same).select("id", "h1", "h2", "line")
    return own.cut(with_codes(read, ranks).where((F.xxhash64("codes") == F.col("h1"))
                                                 & (F.xxhash64(F.lit("second"), "codes") == F.col("h2")))
                   .dropDuplicates(["id"]).select("id", "codes"), "lines-coded")


def alike(pairs: DataFrame, coded: DataFrame, threshold: Fraction) -> DataFrame:
    """Ids of the later sets of those pairs (``later``, ``earlier``) whose similarity reaches the threshold."""
    need = overlap_sql(threshold, "size(x)", "size(y)")
    return (pairs.join(coded.select(F.col("id").alias("later"), F.col("codes").alias("x")), "later")
            .join(coded.select(F.col("id").alias("earlier"), F.col("codes").alias("y")), "earlier")
            .where(f"size(array_intersect(x, y)) >= {need}").select(F.col("later").alias("id")).distinct())


def matched(busy: DataFrame, threshold: Fraction) -> DataFrame:
    """The postings that length and parity allow a partner at their key: most need no words to be read."""
    other = F.expr("a.code = b.code and a.id <> b.id and " + fits(threshold))
    return busy.alias("a").join(busy.alias("b"), other, "left_semi")


def with_earlier(busy: DataFrame, coded: DataFrame, threshold: Fraction) -> DataFrame:
    """Ids of the sets that resemble an earlier one with which they share a key of ``busy``.

    A semi join looks for one such set and no further, so it hands on no more rows than there are postings.
    """
    held = busy.join(coded, "id")
    need = overlap_sql(threshold, "a.n", "b.n")
    earlier = F.expr(f"a.code = b.code and a.id <> b.id and b.first < a.first and {fits(threshold)}"
                     f" and size(array_intersect(a.codes, b.codes)) >= {need}")
    return held.alias("a").join(held.alias("b"), earlier, "left_semi").select("id").distinct()


def later_sets(sets: DataFrame, docs: DataFrame, ranks: DataFrame | None, threshold: Fraction) -> DataFrame:
    """Ids of the sets that resemble a set which occurs earlier.

    A set goes as soon as one pair holds. Sets of hot keys are settled first, then each set's closest pair by parity is
    verified; only sets that these do not settle are held against all their others.
    """
    with Scratch(sets.sparkSession) as own:
        shared = own.cut(shared_postings(sets, threshold), "lines-shared")
        usual, busy = shared.where(F.col("many") < HOT), shared.where(F.col("many") >= HOT)
        met = (usual.alias("a").join(usual.alias("b"), F.expr("a.code = b.code and a.id < b.id and " + fits(threshold)))
               .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
        pairs = own.cut(plausible(own.cut(met, "lines-met"), sets, threshold), "lines-pairs")
        busy = busy.drop("many").join(sets.select("id", "first"), "id")
        busy = own.cut(matched(own.cut(busy, "lines-hot"), threshold), "lines-busy")
        ids = pairs.select(F.explode(F.array("later", "earlier")).alias("id")).unionByName(busy.select("id"))
        coded = word_sets(ids, sets, docs, ranks, own)
        hot = own.cut(with_earlier(busy, coded, threshold), "lines-hot-gone")
        pairs = pairs.join(hot.withColumnRenamed("id", "later"), "later", "left_anti")
        closest = pairs.groupBy("later").agg(F.min(F.struct("apart", "earlier")).alias("p")).select("later", "p.earlier")
        first = own.cut(hot.unionByName(alike(closest, coded, threshold)), "lines-settled")
        rest = pairs.join(first.withColumnRenamed("id", "later"), "later", "left_anti")
        return cut(first.unionByName(alike(rest, coded, threshold)), "lines-gone")


def removed_lines(docs: DataFrame, threshold: Fraction = THRESHOLD, min_words: int = MIN_WORDS,
                  counted: bool = False) -> DataFrame:
    """Per document with later matches: ``doc_id``, ``row`` (hash of its text) and ``gone`` (their line numbers)."""
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession) as own:
        ranks = own.cut(word_ranks(docs), "lines-ranks") if counted else None
        lines = own.cut(set_lines(docs, ranks, threshold, min_words), "lines")
        sets = own.cut(lines.groupBy("h1", "h2").agg(
            F.min(F.struct("doc_id", "line_no", "row")).alias("first"), F.count("*").alias("copies"),
            *[F.first(name).alias(name) for name in ("n", "parity", "wide", "last", "prefix")])
            .withColumn("id", F.monotonically_increasing_id()), "lines-sets")
        later = later_sets(sets, docs, ranks, threshold)
        touched = (sets.select("id", "h1", "h2", "first", "copies")
                   .join(later.withColumn("later", F.lit(True)), "id", "left")
                   .where("later or copies > 1").select("h1", "h2", "first", "later"))
        same = " and ".join(f"first.{c} <=> {c}" for c in ("doc_id", "line_no", "row"))
        return cut(lines.select("doc_id", "row", "line_no", "h1", "h2").join(touched, ["h1", "h2"])
                   .where(f"later or not ({same})")
                   .groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("gone")), "lines-at")


def dedup_lines(docs: DataFrame, threshold: Fraction = THRESHOLD, min_words: int = MIN_WORDS,
                counted: bool = False) -> DataFrame:
    """All documents, ``text`` without its later matches, and two more columns: ``n_lines``, ``n_removed``."""
    gone = removed_lines(docs, threshold, min_words, counted)
    key, row, at, lines = (fresh(docs, f"line_{name}") for name in ("key", "row", "gone", "parts"))
    gone = gone.select(F.col("doc_id").alias(key), F.col("row").alias(row), F.col("gone").alias(at))
    # Documents that surely keep all lines are not shuffled.
    touched = among([docs["doc_id"].cast("long"), F.xxhash64(docs["text"])], gone, [key, row])
    near = docs.where(touched)
    near = near.join(gone, near["doc_id"].cast("long").eqNullSafe(gone[key])
                     & (F.xxhash64(near["text"]) == gone[row]), "left").drop(key, row)
    joined = near.unionByName(docs.where(~touched).withColumn(at, F.lit(None).cast("array<int>")))
    joined = joined.withColumn(lines, settled(F.split("text", "\n")))
    kept = F.expr(f"""array_join(transform(sort_array(array_except(sequence(0, size(`{lines}`) - 1), `{at}`)),
                                           i -> element_at(`{lines}`, i + 1)), '\n')""")
    return (joined.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)))
            .withColumn("n_removed", F.coalesce(F.size(at), F.lit(0)))
            .withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(kept))
            .drop(at, lines))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Prefixes by alphabetical order of the words themselves: another order and no hashes, the same pairs.
OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL),
worded AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
           string_split_regex(lower(line), '[\\x09-\\x0D ]+'), lambda w: w <> ''))) AS words FROM lines),
worded_lines AS (SELECT * FROM worded WHERE len(words) >= 1),
sets AS (SELECT words, min(row(doc_id, line_no)) AS first, len(words) AS n,
                row_number() OVER (ORDER BY words) AS id FROM worded_lines GROUP BY words),
prefixes AS (SELECT id, n, unnest(words[1:(n - (4 * n + 4) // 5 + 1)]) AS w FROM sets),
pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM prefixes a JOIN prefixes b
          ON a.w = b.w AND a.id < b.id AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
alike AS (SELECT CASE WHEN x.first > y.first THEN x.id ELSE y.id END AS id
            FROM pairs JOIN sets x ON x.id = pairs.a JOIN sets y ON y.id = pairs.b
            WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (x.n + y.n)),
gone AS (SELECT DISTINCT l.doc_id, l.line_no FROM worded_lines l JOIN sets s ON s.words = l.words
         WHERE s.id IN (SELECT id FROM alike) OR s.first <> row(l.doc_id, l.line_no)),
kept AS (SELECT l.doc_id, count(*)::INTEGER AS n_lines, count(g.line_no)::INTEGER AS n_removed,
                coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.line_no IS NULL), '') AS text
         FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
