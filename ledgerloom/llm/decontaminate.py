"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, names and units become typed placeholders, so a question with other values has the
same template. Windows of ``WINDOW`` template words of benchmark items and documents meet
in a hash join, once with placeholders for names and once with the names as lower-case words,
so that neither case nor punctuation hides a copy. Where enough windows of an item follow each
other in a document, the values in the slots are compared: a name or unit of the item, or a number
of it before the same word, stands for one thing, so a question that was only given other values has
one value for it wherever it stands. (Equal numbers before different words may be equal by
chance, so nothing is asked of them.) A slot agrees when most places of its thing have its value in
the document. Where less than ``CONSISTENT`` of all slots agree, by weight (units count half), the
text is another question, unless ``VERBATIM`` words in a row are the item's own.

Items without a window that is evidence (short ones, those of placeholders) are looked for as
they are: all their words, values included, in a hash join of windows of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Scratch, broadcast_if_few, broadcast_if_light

WINDOW = 8
#: Words of a window that are no placeholders.
PLAIN = 5
#: Words in a row with their values that are a copy, however other values go together: two windows side by side.
VERBATIM = 2 * WINDOW
#: The part of the slots, by weight, whose values must go together.
CONSISTENT = 0.8
UNIT_WEIGHT = 0.5
#: Words in a row that an item and a document must share (all of a shorter item's).
LEAST_WORDS = 13

# A word with a capital inside a sentence, numbers, units (after a number, anywhere).
NAME = r" (?<=[\p{Ll}\p{Nd},;] )\p{Lu}[\p{L}\p{M}'’-]*"
NUMBER = r"[+-]?\d+(?:[.,:/]\d+)*"
SHORT_UNITS = "mm|cm|dm|km|m|mg|kg|g|t|ml|cl|l|ms|s|min|h|hz|khz|mhz|kb|mb|gb|tb|w|kw|kwh|v|a|mph|kmh|ft|in|lb|oz"
LONG_UNITS = (
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre"
    " centimetres mile miles feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces"
    " ton tons tonne tonnes liter liters litre litres gallon gallons second seconds minute minutes hour hours"
    " day days week weeks month months year years degree degrees percent dollar dollars euro euros cent cents"
).split()
AFTER_NUMBER = rf"(?i)(?<=<num>)(\s?)(?:{SHORT_UNITS}|[%°$€£])(?![\p{{L}}\p{{N}}])"
PLACEHOLDER = "<(?:num|name|unit)>"
DROPPED = ".,;:!?\"()[]{}«»“”„¿¡"


def _words(text: Column) -> Column:
    plain = F.btrim(F.translate(F.lower(text), DROPPED, ""), F.lit(" \t\n\x0b\f\r"))
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def template(text: Column) -> Column:
    """The words of a text with placeholders. It has as many words as the text, place by place."""
    names = F.regexp_replace(text, NAME, " <name>")
    numbers = F.regexp_replace(F.regexp_replace(names, NUMBER, "<num>"), AFTER_NUMBER, "$1<unit>")
    words = _words(F.when(text.rlike(r"\d"), numbers).otherwise(names))
    return F.transform(words, lambda w: F.when(w.isin(LONG_UNITS), "<unit>").otherwise(w))


def folded(words: str, text: Column) -> Column:
    """A template (a column) with its names as lower-case words, which hang on neither case nor punctuation."""
    own = lambda w, v: F.when(w.contains("<name>"), F.regexp_replace(v, NUMBER, "<num>")).otherwise(w)
    named = F.exists(words, lambda w: w.contains("<name>"))
    return F.when(named, F.zip_with(words, _words(text), own))


def windows(words: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words of a column (an expression would be worked out for each run)."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(at, lambda k: F.xxhash64(F.slice(words, k, width)))


def _items(benchmark: DataFrame) -> DataFrame:
    own = benchmark.where("text is not null").select("item_id", F.col("text").cast("string")).distinct()
    return own.select(
        "item_id",
        "text",
        F.xxhash64("text").alias("item_text"),
        template(F.col("text")).alias("item_words"),
        _words(F.col("text")).alias("item_values"),
    ).withColumn("item_folded", F.coalesce(folded("item_words", F.col("text")), "item_words"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, width: int = WINDOW, plain: int = PLAIN, least: int = LEAST_WORDS
) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, n_slots, changed_slots``: items that documents hold.

    One row for each document and item, with the longest place where they meet; ``first_word``
    counts the document's words from 0. Null and empty texts, and items without words, match
    nothing; texts of any length are read whole. Rows of ``docs`` with equal doc_id are searched
    each for itself and give one row together; null ids match as any other. Empty tables give no
    rows; other columns are not read.
    """
    best = held(docs, benchmark, width=width, plain=plain, least=least).groupBy("doc_id", "item_id").agg(F.max("r").alias("r"))
    return best.select(
        "doc_id",
        "item_id",
        (-F.col("r.early")).alias("first_word"),
        F.col("r.n_words").alias("n_words"),
        F.col("r.n_slots").alias("n_slots"),
        F.col("r.changed").alias("changed_slots"),
    )


def held(docs: DataFrame, benchmark: DataFrame, *, width: int = WINDOW, plain: int = PLAIN, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, copy, item_id, r``: every place, with the 64-bit hash of the document's text."""
    kept = Scratch(docs.sparkSession, "decontaminate")
    items = kept.store(_items(benchmark))
    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("copy")
    )

    def eligible(words: str) -> DataFrame:
        parts = items.select("item_id", "item_text", words, F.size(words).alias("n"))
        return (
            parts.select("item_id", "item_text", "n", words, F.posexplode(windows(words, width)))
            .withColumn("own", F.slice(words, F.col("pos") + 1, width))
            .where(F.size(F.filter("own", lambda w: ~w.rlike(PLACEHOLDER))) >= plain)
            .select("item_id", "item_text", F.col("pos").alias("item_at"), F.col("col").alias("window"), "n")
        )

    runs = eligible("item_words").withColumn("typed", F.lit(1)).union(eligible("item_folded").withColumn("typed", F.lit(0)))
    per_item = runs.groupBy("item_id", "item_text").agg(F.sum("typed").alias("typed"), F.sum(1 - F.col("typed")).alias("folded"))
    # An item's windows with too few plain words are no evidence either way, and none of them is asked for.
    needed = F.least(
        F.least(F.lit(least), F.col("n") - width + plain) - width + 1, F.when(F.col("typed") > 0, F.col("typed")).otherwise(F.col("folded"))
    )
    listed = kept.store(
        runs.drop("typed").distinct().join(per_item, ["item_id", "item_text"])
        .select("item_id", "item_text", "item_at", "window", "n", F.greatest(needed, F.lit(1)).alias("needed"))
    )
    whole = _whole_items(texts, kept.store(items.join(listed, ["item_id", "item_text"], "left_anti")), width)
    listed = broadcast_if_few(listed)

    at = lambda words: F.transform(windows(words, width), lambda h, k: F.struct(k.alias("at"), h.alias("window")))
    both_ways = F.concat(at("words"), F.when(F.col("folded").isNotNull(), at("folded")).otherwise(F.array().cast("array<struct<at:int,window:bigint>>")))
    met = (
        texts.select("copy", "text", template(F.col("text")).alias("words"))
        .select("copy", "words", folded("words", F.col("text")).alias("folded"))
        .select("copy", F.inline(both_ways))
        .join(listed, "window")
        .groupBy("copy", "item_id", "item_text", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(
            F.countDistinct("item_at").alias("met"),
            F.min("item_at").alias("first"),
            F.max("item_at").alias("last"),
            F.max("n").alias("n"),
            F.max("needed").alias("needed"),
        )
        .where("met >= needed")
    )
    met = kept.store(met)

    # The values in the slots, of those documents alone.
    held = met.select("copy").distinct()
    again = (
        texts.join(broadcast_if_few(kept.store(held)), "copy", "left_semi")
        .dropDuplicates(["copy"])  # equal texts have equal words
        .select("copy", "text", _words(F.col("text")).alias("values"), template(F.col("text")).alias("words"))
        .withColumn("folded", F.coalesce(folded("words", F.col("text")), "words"))
        .drop("text")
    )
    # Documents are wide and not sent whole, items where they are light: many documents may hold one.
    light = broadcast_if_light(items, 8 * F.length("text"))
    both = met.join(kept.store(again).hint("merge"), "copy").join(light, ["item_id", "item_text"])
    # The place goes on, beyond the windows that met, for as long as the templates agree.
    place = F.sequence(F.lit(0), F.size("item_words") - 1)
    there = lambda k: k + F.col("shift").cast("int")
    agrees = lambda k: (
        (F.get("words", there(k)) == F.get("item_words", k)) | (F.get("folded", there(k)) == F.get("item_folded", k))
    )
    both = both.withColumn("bad", F.filter(place, lambda k: ~F.coalesce(agrees(k), F.lit(False))))
    stop = F.col("last") + width - 1
    both = both.select(
        "*",
        (F.coalesce(F.array_max(F.filter("bad", lambda k: k < F.col("first"))), F.lit(-1)) + 1).alias("begin"),
        F.coalesce(F.array_min(F.filter("bad", lambda k: k > stop)), F.size("item_words")).alias("end"),
    )
    n = F.col("end") - F.col("begin")
    part = lambda own, other: (
        F.slice(own, F.col("begin") + 1, n), F.slice(other, F.col("begin") + 1 + F.col("shift"), n)
    )
    after = F.slice("item_words", F.col("begin") + 2, n)  # the word after each
    place = F.arrays_zip(*part("item_words", "words"), *part("item_values", "values"), *part("item_folded", "folded"), after)
    typed = lambda p, own, other: (p[own] == p[other]) & p[own].rlike(PLACEHOLDER)
    slots = F.filter(place, lambda p: typed(p, "0", "1") | typed(p, "4", "5"))
    both = both.where(n >= F.least(F.lit(least), F.col("n") - width + plain))
    found = kept.store(slots_consistent(both, slots, n, F.transform(place, lambda p: p["2"] == p["3"])))
    # Texts were judged once each; every row with such a text holds what it holds.
    return texts.select("doc_id", "copy").join(broadcast_if_few(found), "copy").select("doc_id", "copy", "item_id", "r").unionByName(whole)


def slots_consistent(both: DataFrame, slots: Column, n: Column, equal: Column) -> DataFrame:
    """Keeps places where enough of the slots' values go together, or that hold a long verbatim run."""
    number = lambda p: p["0"].contains("<num>") | p["4"].contains("<num>")
    thing = lambda p: F.when(number(p), F.concat_ws(" ", p["2"], p["6"])).otherwise(p["2"])
    weight = lambda p: F.when(p["0"] == "<unit>", F.lit(UNIT_WEIGHT)).otherwise(F.lit(1.0))
    slot = lambda p: F.struct(p["2"].alias("x"), p["3"].alias("y"), thing(p).alias("thing"), weight(p).alias("weight"))
    both = both.select(
        "copy", "item_id", (F.col("begin") + F.col("shift")).alias("first_word"), n.alias("n_words"), "met",
        F.transform(slots, slot).alias("slots"),
        equal.alias("equal"),
    ).withColumn("unlike", F.filter(F.transform("equal", lambda e, k: F.when(~e, k)), lambda k: k.isNotNull()))
    alike = lambda p: F.filter("slots", lambda q: q["thing"] == p["thing"])
    agrees = lambda p: 2 * F.size(F.filter(alike(p), lambda q: q["y"] == p["y"])) > F.size(alike(p))
    sum_ = lambda of: F.aggregate(of, F.lit(0.0), lambda s, p: s + p["weight"])
    consistent = sum_(F.filter("slots", agrees)) >= CONSISTENT * sum_("slots")
    runs = F.zip_with(
        F.concat("unlike", F.array(F.size("equal"))), F.concat(F.array(F.lit(-1)), "unlike"), lambda stop, before: stop - before - 1
    )
    row = F.struct(
        "met", "n_words", (-F.col("first_word")).alias("early"),
        F.size("slots").alias("n_slots"),
        F.size(F.filter("slots", lambda p: p["x"] != p["y"])).alias("changed"),
    )
    return both.where(consistent | (F.array_max(runs) >= VERBATIM)).select("copy", "item_id", row.alias("r"))


def _whole_items(texts: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Places that hold all words of an item, values included; for items without windows that are evidence."""
    own = items.where(F.size("item_values") > 0).select(
        "item_id",
        F.size("item_values").alias("n"),
        F.xxhash64("item_values").alias("whole"),
        F.least(F.size("item_values"), F.lit(width)).alias("span"),
        F.xxhash64(F.slice("item_values", 1, width)).alias("window"),
        F.size(F.filter("item_words", lambda w: w.rlike(PLACEHOLDER))).alias("n_slots"),
    )
    spans = [r["span"] for r in own.select("span").distinct().orderBy("span").collect()]  # ``width`` of them at most

    def at(span: int) -> Column:
        return F.transform(windows("values", span), lambda h, k: F.struct(k.alias("at"), F.lit(span).alias("span"), h.alias("window")))

    places = F.concat(*map(at, spans)) if spans else F.array().cast("array<struct<at:int,span:int,window:bigint>>")
    met = F.greatest(F.col("n") - width + 1, F.lit(1)).cast("long")
    row = F.struct(
        met.alias("met"), F.col("n").alias("n_words"), (-F.col("at")).alias("early"), "n_slots", F.lit(0).alias("changed")
    )
    # Only as much of a document as the longest item goes along.
    longest = own.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return (
        texts.where(F.lit(bool(spans)))
        .select("doc_id", "copy", _words(F.col("text")).alias("values"))
        .select("doc_id", "copy", "values", F.inline(places))
        .withColumn("values", F.slice("values", F.col("at") + 1, max(longest, 1)))
        .join(F.broadcast(own) if own.count() <= 10_000 else own.hint("merge"), ["span", "window"])
        .where(F.xxhash64(F.slice("values", F.lit(1), F.col("n"))) == F.col("whole"))
        .select("doc_id", "copy", "item_id", row.alias("r"))
    )
