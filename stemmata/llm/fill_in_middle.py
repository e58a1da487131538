"""Fill-in-the-middle, as relations of units.

A text is cut into units (white space and the word after it, or white space alone). Two cut requests stand for each text that
is transformed, by unit ordinal. The units are exploded with their ordinals, a running sum of their lengths says where each
ends, requests are joined by ordinal, and the offsets of a text are brought together to cut it into prefix, middle and suffix.

Texts are known by doc_id and two hashes of the text: rows that are equal in both are one text, whose units are made once,
however often it is repeated, and whose result all of them get; only those of one doc_id could ever be mistaken for each other.
Running sums stand by text, so no group is longer than a text has units.

Defined cases: a null text counts as empty, an empty one is plain with no units; a null doc_id draws as the empty string does;
rows of equal doc_id and different texts are cut by the same draws, each in its own units; repeated rows give repeated results;
extra columns pass through, but for those named as results, which give way; an empty table gives no rows. A text that contains a sentinel
is plain, so that a transformed one can always be taken apart again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, table

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")
_KEY = ["__id", "__hash", "__hash2"]


def draws(seed: int, ids: Column) -> list[Column]:
    """The four unsigned numbers that a document draws."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def requests(docs: DataFrame, seed: int, percent: int, percent_spm: int) -> DataFrame:
    """Adds the number of units n, the form, and the ordinals of the units after which the text is cut (first <= second)."""
    one, two, chosen, order = draws(seed, F.col("doc_id"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (chosen % 100 >= percent)
    counted = docs.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    counted = counted.withColumn("form", F.when(plain, "plain").when(order % 100 < percent_spm, "spm").otherwise("psm"))
    cuts = [x % (F.col("n") + 1) for x in (one, two)]
    return counted.withColumns({"first": F.least(*cuts).cast("int"), "second": F.greatest(*cuts).cast("int")})


def unit_ends(texts: DataFrame) -> DataFrame:
    """The key of each text with the ordinal of each unit up to the second cut, and the place in the text where it ends."""
    lengths = F.transform(F.regexp_extract_all("text", F.lit(UNIT), F.lit(0)), F.length)
    units = texts.select(*_KEY, F.posexplode(F.slice(lengths, F.lit(1), F.col("second"))).alias("before", "chars"))
    return units.select(*_KEY, (F.col("before") + 1).alias("ordinal"), F.sum("chars").over(Window.partitionBy(*_KEY).orderBy("before")).alias("end"))


def offsets(asked: DataFrame) -> DataFrame:
    """Key, start of the middle and start of the suffix of each text that is cut after some unit."""
    # Aggregated, so that repeated rows are one before they are moved.
    texts = asked.groupBy(*_KEY).agg(F.any_value("text").alias("text"), F.any_value("second").alias("second"))
    wanted = asked.groupBy(*_KEY).agg(F.any_value("first").alias("first"), F.any_value("second").alias("second"))
    # By the text's key alone, as both sides are dealt out by it: units meet the two requests of their own text.
    met = unit_ends(texts).join(wanted, _KEY).where((F.col("ordinal") <= F.col("second")) & (F.col("ordinal") >= F.col("first")) & F.col("ordinal").isin(F.col("first"), F.col("second")))
    at = lambda c: F.coalesce(F.max(F.when(F.col("ordinal") == F.col(c), F.col("end"))), F.lit(0))
    return met.groupBy(*_KEY).agg(at("first").alias("middle_at"), at("second").alias("suffix_at"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form."""
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    between = lambda a, b: F.substr(output, a + 3, b - a - 3)
    end = F.substr(output, m + 3)
    return F.when(form == "psm", F.concat(between(p, s), end, between(s, m))).when(form == "spm", F.concat(between(p, m), end, between(s, p))).otherwise(output)


def fill_in_middle(documents: DataFrame, seed: int = 42, percent: int = 50, percent_spm: int = 80) -> DataFrame:
    """All columns, the number of units n, the form (plain, psm, spm), the lengths of prefix and middle (null: plain), and the output text."""
    docs, back = carried(documents.drop(*RESULTS), "doc_id", "text")
    docs = docs.withColumn("__null", F.col("text").isNull()).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    docs = requests(docs, seed, percent, percent_spm)
    plain = docs.where("form = 'plain'").withColumns({"prefix_chars": F.lit(None).cast("long"), "middle_chars": F.lit(None).cast("long"), "output": F.col("text")})
    asked = docs.where("form != 'plain'").withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "__hash": F.xxhash64("text"), "__hash2": F.xxhash64(F.lit(7), "text")})
    cut = asked.join(offsets(asked), _KEY, "left").na.fill(0, ["middle_at", "suffix_at"])
    prefix, middle = F.substr("text", F.lit(1), F.col("middle_at")), F.substr("text", F.col("middle_at") + 1, F.col("suffix_at") - F.col("middle_at"))
    suffix = F.substr("text", F.col("suffix_at") + 1)
    parts = {"psm": (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle), "spm": (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)}
    joined = lambda form: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts[form]])
    done = cut.withColumns({"prefix_chars": F.col("middle_at").cast("long"), "middle_chars": (F.col("suffix_at") - F.col("middle_at")).cast("long"), "output": F.when(F.col("form") == "psm", joined("psm")).otherwise(joined("spm"))})
    both = plain.select(*plain.columns).unionByName(done.select(*plain.columns)).withColumn("text", F.when(~F.col("__null"), F.col("text")))
    return both.select(*back, *RESULTS)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
