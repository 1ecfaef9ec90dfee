"""Benchmark decontamination by templates, in DataFrame and SQL functions only.

A text becomes its words and numbers. Numbers, names (words with a capital first letter) and units turn into typed
placeholders, other words into lower case, so a question whose numbers or names were exchanged keeps its template.
Windows of ``WINDOW`` neighbouring template words are hashed and joined with those of the benchmark; windows with
fewer than ``LITERALS`` ordinary words say too little and are left out. The windows that a document shares with an item
are lined up by their distance (position in the document minus position in the item). The words behind their
placeholders must agree: every value in the item stands for itself or for one other value in the document; two values
may become one. An item leaked when one such line holds ``ENOUGH`` windows, or all the item has if these are fewer, or
when a line, whatever its other slots, holds as many windows word for word.

What is a name depends on the case of the copy, so windows are also matched in lower case, with only numbers and units
as slots. A line takes the windows of both kinds and their slots together.

Only window hashes of documents are exploded, and nothing is collected. The benchmark is broadcast when its windows
number at most ``BROADCAST_ROWS``, otherwise both sides are shuffled by the hash; the rows are the same.

Defined cases: null and empty texts and items without a usable window match nothing; repeated rows count once;
rows with one ``doc_id`` and different texts are looked at apart; a null id is kept as such. Ties in the number of
windows go to the earlier place in the document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import among, cut, fresh, settled, table, without

WINDOW, LITERALS, ENOUGH = 8, 4, 6
BROADCAST_ROWS = 500_000  # of 24 bytes
WORD = r"[\p{L}\p{M}]+|[0-9]+(?:[.,][0-9]+)*"
# Units of measure.
UNITS = ("mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre",
         "kilometres", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram",
         "grams", "kilogram", "kilograms", "ton", "tons", "tonne", "tonnes", "ounce", "ounces", "pound", "pounds",
         "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups", "second", "seconds",
         "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
         "cent", "cents", "dollar", "dollars", "euro", "euros", "percent", "degree", "degrees", "mph", "kmh", "watt",
         "watts", "volt", "volts")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def template_word(word: Column) -> Column:
    low, first = F.lower(word), F.substring(word, 1, 1)
    return (F.when((first >= "0") & (first <= "9"), "<num>").when(low.isin(*UNITS), "<unit>")
            .when(first != F.lower(first), "<name>").otherwise(low))


def folded_word(word: Column) -> Column:
    low, template = F.lower(word), template_word(word)
    return F.when(template == "<name>", low).otherwise(template)


def is_slot(template: Column) -> Column:
    return F.substring(template, 1, 1) == "<"


def with_hashes(texts: DataFrame, template: Callable[[Column], Column] = template_word,
                name: str = "hashes") -> DataFrame:
    """Adds the hash of every window of template words, and their words as ``words``."""
    out = texts if "words" in texts.columns else texts.withColumn("words", settled(words_of(F.col("text"))))
    out = out.withColumn("each", settled(F.transform("words", lambda w: F.xxhash64(template(w)))))
    return out.withColumn(name, F.when(F.size("each") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("each") - WINDOW + 1), lambda i: F.xxhash64(F.slice("each", i, WINDOW)))))


def item_windows(benchmark: DataFrame, folded: bool = False) -> DataFrame:
    """Usable windows: ``item_id, item_pos, hash, item_words, item_templates, usable`` (windows of the item)."""
    template = folded_word if folded else template_word
    items = with_hashes(benchmark.where("item_id is not null and text is not null").select("item_id", "text")
                        .distinct(), template).withColumn("templates", F.transform("words", template))
    windows = items.select("item_id", "words", "templates", F.posexplode("hashes").alias("item_pos", "hash"))
    at = F.col("item_pos") + 1
    windows = windows.select(
        "item_id", F.xxhash64("words").alias("version"), F.lit(folded).alias("folded"), "item_pos", "hash",
        F.slice("words", at, WINDOW).alias("item_words"), F.slice("templates", at, WINDOW).alias("item_templates"))
    windows = windows.where(F.size(F.filter("item_templates", lambda w: ~is_slot(w))) >= LITERALS)
    usable = windows.groupBy("item_id", "version").agg(F.count("*").alias("usable"))
    return windows.join(usable, ["item_id", "version"])


def all_of_a_kind() -> list[Column]:
    """Whether a line holds all usable windows of its item, as ``all_typed`` and ``all_folded``."""
    return [F.coalesce(F.count_distinct(F.when(kind, F.col("item_pos"))) >= F.max(F.when(kind, F.col("usable"))),
                       F.lit(False)).alias(name)
            for kind, name in ((~F.col("folded"), "all_typed"), (F.col("folded"), "all_folded"))]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaked items by document: ``doc_id, row`` (hash of its text), ``item_id, n_windows, first_word``."""
    windows = cut(item_windows(benchmark).unionByName(item_windows(benchmark, folded=True)), "leak-items")
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                                  F.xxhash64("text").alias("row"))
    hashes = with_hashes(with_hashes(texts), folded_word, "lower")
    hashes = hashes.select("doc_id", "row", F.posexplode(F.arrays_zip("hashes", "lower")).alias("doc_pos", "z"))
    hashes = hashes.select("doc_id", "row", "doc_pos",  # a window without a name has one hash
                           F.explode(F.array_distinct(F.array("z.hashes", "z.lower"))).alias("hash"))
    known = windows.select("hash").distinct()
    if windows.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    hits = cut(hashes.join(known, "hash").distinct(), "leak-hits")

    # The words behind the hits: only documents that have any are read again.
    spots = hits.groupBy("doc_id", "row").agg(F.collect_list(F.struct("doc_pos", "hash")).alias("spots"))
    spots = spots.select(F.col("doc_id").alias("spot_id"), F.col("row").alias("spot_row"), "spots")
    spots = cut(spots, "leak-spots")
    near = texts.where(among([texts["doc_id"], texts["row"]], spots, ["spot_id", "spot_row"]))
    seen = (near.join(spots, near["doc_id"].eqNullSafe(F.col("spot_id")) & (F.col("row") == F.col("spot_row")))
            .select("doc_id", "row", settled(words_of(F.col("text"))).alias("words"), "spots"))
    seen = seen.select("doc_id", "row", F.explode(F.transform("spots", lambda s: F.struct(
        s["doc_pos"].alias("doc_pos"), s["hash"].alias("hash"),
        F.slice(F.col("words"), s["doc_pos"] + 1, WINDOW).alias("doc_words")))).alias("w")
    ).select("doc_id", "row", "w.*").distinct()
    aligned = (seen.join(windows, "hash")
               .where(F.when(F.col("folded"), F.transform("doc_words", folded_word))
                      .otherwise(F.transform("doc_words", template_word)) == F.col("item_templates"))
               .withColumn("line", F.col("doc_pos") - F.col("item_pos")))
    aligned = aligned.withColumns({side: F.transform(side, F.lower) for side in ("item_words", "doc_words")})
    slots = F.filter(F.arrays_zip("item_templates", "item_words", "doc_words"),
                     lambda z: is_slot(z["item_templates"]))
    verbatim = F.when(F.col("folded") & (F.col("item_words") == F.col("doc_words")), F.col("item_pos"))
    lines = aligned.withColumn("slots", slots).groupBy("doc_id", "row", "item_id", "version", "line").agg(
        F.count_distinct("item_pos").alias("n_windows"), *all_of_a_kind(),
        F.count_distinct(verbatim).alias("verbatim"), F.max(F.when(F.col("folded"), F.col("usable"))).alias("all"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))  # bounded by the item's length

    changed = F.filter("slots", lambda z: z["item_words"] != z["doc_words"])
    stand_for = F.transform(changed, lambda z: F.struct(z["item_templates"], z["item_words"]))
    consistent = F.size(F.array_distinct(stand_for)) == F.size(changed)
    copied = F.coalesce(F.col("verbatim") >= F.least(F.lit(ENOUGH), F.col("all")), F.lit(False))
    whole = consistent & ((F.col("n_windows") >= ENOUGH) | F.col("all_typed") | F.col("all_folded"))
    best = lines.where(whole | copied).withColumn("n_windows", F.when(whole, F.col("n_windows"))
                                                  .otherwise(F.col("verbatim")))
    return (best.groupBy("doc_id", "row", "item_id")
            .agg(F.max(F.struct("n_windows", (-F.col("line")).alias("place"))).alias("b"))
            .select("doc_id", "row", "item_id", F.col("b.n_windows").alias("n_windows"),
                    (-F.col("b.place")).alias("first_word")))


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; all columns stay as they are."""
    key, row = fresh(docs, "leak_id"), fresh(docs, "leak_row")
    gone = cut(leaks(docs, benchmark).select(F.col("doc_id").alias(key), F.col("row").alias(row)).distinct(), "leak-gone")
    return without(docs, [docs["doc_id"].cast("long"), F.xxhash64(docs["text"])], gone, [key, row])


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_windows").cast("int").alias("n_windows"), "first_word")


OP9_SQL = f"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
worded AS (SELECT kind, id, regexp_extract_all(text, '[\\p{{L}}\\p{{M}}]+|[0-9]+(?:[.,][0-9]+)*') AS words FROM texts),
templated AS (
  SELECT *, list_transform(words, lambda w: lower(w)) AS said, list_transform(words, lambda w: CASE
    WHEN w[1] BETWEEN '0' AND '9' THEN '<num>'
    WHEN lower(w) IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN '<unit>'
    WHEN w[1] <> lower(w[1]) THEN '<name>' ELSE lower(w) END) AS templates FROM worded),
starts AS (SELECT *, unnest(range(len(words) - {WINDOW - 1})) AS pos FROM templated WHERE len(words) >= {WINDOW}),
typed AS (SELECT kind, id, pos, said[pos + 1:pos + {WINDOW}] AS ws, templates[pos + 1:pos + {WINDOW}] AS ts FROM starts),
windows AS (
  SELECT *, false AS folded FROM typed UNION ALL
  SELECT kind, id, pos, ws, list_transform(list_zip(ws, ts), lambda z: CASE WHEN z[2] = '<name>' THEN z[1] ELSE z[2] END),
         true FROM typed),
items AS (
  SELECT id AS item_id, pos AS item_pos, ws AS item_words, ts, folded,
         count(*) OVER (PARTITION BY id, folded) AS usable FROM windows
  WHERE kind = 'b' AND len(list_filter(ts, lambda t: t[1] <> '<')) >= {LITERALS}),
hits AS (
  SELECT w.id AS doc_id, w.pos - item_pos AS line, item_id, item_pos, usable, folded, ts, item_words, w.ws AS doc_words
  FROM windows w JOIN items USING (ts, folded) WHERE kind = 'd'),
slots AS (
  SELECT DISTINCT doc_id, item_id, line, unnest(ts) AS t, unnest(item_words) AS x, unnest(doc_words) AS y FROM hits),
clashes AS (
  SELECT DISTINCT doc_id, item_id, line, true AS clash FROM (
    SELECT doc_id, item_id, line FROM slots WHERE t[1] = '<' AND x <> y
    GROUP BY doc_id, item_id, line, t, x HAVING count(*) > 1)),
lines AS (
  SELECT doc_id, item_id, line, count(DISTINCT item_pos) AS n,
         count(DISTINCT item_pos) FILTER (NOT folded) >= max(usable) FILTER (NOT folded) AS all_typed,
         count(DISTINCT item_pos) FILTER (folded) >= max(usable) FILTER (folded) AS all_folded,
         count(DISTINCT item_pos) FILTER (folded AND item_words = doc_words) AS verbatim,
         max(usable) FILTER (folded) AS every
  FROM hits GROUP BY ALL),
judged AS (
  SELECT doc_id, item_id, line, n, verbatim,
         clash IS NULL AND (n >= {ENOUGH} OR coalesce(all_typed, false) OR coalesce(all_folded, false)) AS whole,
         verbatim >= least({ENOUGH}, every) AS copied
  FROM lines LEFT JOIN clashes USING (doc_id, item_id, line)),
found AS (
  SELECT doc_id, item_id, line, CASE WHEN whole THEN n ELSE verbatim END AS n FROM judged WHERE whole OR copied)
SELECT doc_id, item_id, n::INTEGER AS n_windows, line::INTEGER AS first_word FROM found
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, line) = 1
"""
