"""URL filter: rules for hosts and paths, found by a blocked Bloom filter and an exact join.

A rule names a host and the start of a path; it fits that host and all its subdomains. A
URL can only fit rules whose canonical form (host, then path) is one of the URL's own
suffixes of the host followed by one of the starts of its path that are as long as some
rule's path. These candidates pass a blocked Bloom filter of all rules in the row itself;
only possible hits leave it, to an exact hash join that removes false positives.

The filter has a fixed size: a block is one 64-bit word, chosen by the upper bits of a
key's hash; six of the word's bits are set for the key. Blocks are united by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Scratch, broadcast_if_light

#: Blocks of the filter; 16 bits a key are plenty, so this serves some millions of rules in 8 MB.
BLOCKS = 1 << 20
BITS_SET = 6

#: Lengths of rules' paths that a URL's path is cut at one by one.
MOST_LENGTHS = 1024

ALLOW, BLOCK = "allow", "block"

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, *_LOWER)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    return ascii_lower(F.substring_index(F.substring_index(rest, "?", 1), "#", 1))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    at = F.locate("/", rest)
    return F.when(at > 0, F.substr(rest, at)).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _word(key_hash: Column) -> Column:
    """The bits that a key sets in its block."""
    one = F.lit(1).cast("long")
    places = [F.pmod(F.shiftright(key_hash, 6 * k), F.lit(64)).cast("int") for k in range(BITS_SET)]
    bits = [F.call_function("shiftleft", one, place) for place in places]
    word = bits[0]
    for bit in bits[1:]:
        word = word.bitwiseOR(bit)
    return word


def _block(key_hash: Column) -> Column:
    return F.shiftrightunsigned(key_hash, 44).cast("int")


def bloom_words(rules: DataFrame) -> np.ndarray:
    """The filter of all rules' keys: one word a block, united by Spark, ``BLOCKS`` rows at most."""
    hashed = rules.select(F.xxhash64("host", "path").alias("h"))
    blocks = hashed.groupBy(_block(F.col("h")).alias("block")).agg(F.bit_or(_word(F.col("h"))).alias("word"))
    found = blocks.toArrow()
    words = np.zeros(BLOCKS, dtype=np.int64)
    words[found.column("block").to_numpy()] = found.column("word").to_numpy()
    return words


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Distinct ``host, path, verdict``, hosts in lower case; a rule that is listed both ways blocks."""
    return (
        rules.where("host is not null and path is not null")
        .select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )


def judged(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (page_id, url).

    Of the rules that fit, the longest (host and path together; of equal ones that with the
    longer host) gives ``rule`` and ``verdict``. A URL that no rule fits is not listed: no
    rule and ``default``. A null URL, or one without ``://``, has empty host and path. Rows
    with equal or null page_id are judged each for itself; other columns are not read. No
    rules give the default for all, no pages no rows; URLs of any length are judged whole.

    ``rules`` has host, path and verdict (``allow`` or ``block``).
    """
    spark = pages.sparkSession
    rules = canonical_rules(rules)
    words = spark.sparkContext.broadcast(bloom_words(rules))
    # Lengths of rules' paths that occur: a handful as a rule. Of more than MOST_LENGTHS none is named: all starts are tried.
    lengths = sorted(
        row["n"] for row in rules.select(F.length("path").alias("n")).distinct().orderBy("n").limit(MOST_LENGTHS + 1).collect()
    )

    @F.arrow_udf("boolean")
    def possible(block: pa.Array, word: pa.Array) -> pa.Array:
        own = word.to_numpy(zero_copy_only=False)
        return pa.array((words.value[block.to_numpy(zero_copy_only=False)] & own) == own)

    found = pages.select(
        F.col("page_id").cast("long"),
        F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path(F.col("url")), F.lit("")).alias("path"),
    )
    # Whatever is judged depends on host and path alone, so each pair is looked up once.
    pairs = found.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    if len(lengths) > MOST_LENGTHS:
        starts = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    else:
        starts = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths))
    keys = (
        pairs.where("host != ''")
        .select("host", "path", F.explode(suffixes).alias("rule_host"), F.array_compact(starts).alias("starts"))
        .select("host", "path", "rule_host", F.explode("starts").alias("rule_path"))
        .withColumn("h", F.xxhash64("rule_host", "rule_path"))
    )
    hits = keys.where(possible(_block(F.col("h")), _word(F.col("h")))).drop("h")
    listed = broadcast_if_light(
        rules.withColumnsRenamed({"host": "rule_host", "path": "rule_path"}), 40 + F.length("rule_host") + F.length("rule_path")
    )
    size = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = (
        hits.join(listed, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), size).alias("best"))
    )
    # Stored before the join, so a host and path of many pages is split like any other.
    best = Scratch(spark, "url-filter").store(best)
    best = broadcast_if_light(best, 40 + 3 * (F.length("host") + F.length("path")))
    return found.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
