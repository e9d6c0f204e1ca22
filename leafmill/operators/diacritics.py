"""Letters that a reading set apart, rejoined to the neighbour that the document's own vocabulary names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters that are never words, and their older forms.
MARKS = "ăâîșțşţĂÂÎȘȚŞŢ"
OLD_FORMS = ("şţŞŢ", "șțȘȚ")
WORD = r"[\p{L}\p{N}_]+"
# A match begins where a word does and takes all of it, so a word is read once, however long.
_WHOLE = rf"(?<![\p{{L}}\p{{N}}_]){WORD}+"
BETWEEN = rf"({_WHOLE}) ([{MARKS}]) ({WORD}+)"
TAIL = rf"({_WHOLE}) ([{MARKS}])(?![\p{{L}}\p{{N}}_])"
#: The letters as ``canonical`` leaves them.
SET_APART = "ăâîșț"


def canonical(word: Column) -> Column:
    return F.translate(F.lower(word), *OLD_FORMS)


def vocabulary(texts: DataFrame) -> DataFrame:
    """(doc_id, word) of texts (doc_id, text): words that hold a letter that could be set apart, each once."""
    own = F.array_distinct(F.filter(F.regexp_extract_all(canonical(F.col("text")), F.lit(WORD), F.lit(0)), lambda w: F.translate(w, SET_APART, "") != w))
    return texts.select("doc_id", F.explode(own).alias("word")).distinct()


def rejoin(texts: DataFrame, native: DataFrame) -> DataFrame:
    """(doc_id, text_no, text), every split decided by the words of ``native`` (doc_id, text).

    The whole word comes first, then the letter to the left, then to the right; where none
    is known it goes left. The words that a split could form meet the vocabulary as rows, so
    no document's vocabulary is gathered, and each text gets back one number a split. Null
    texts stay null; text_no names a text within its document.
    """
    found = F.regexp_extract_all("text", F.lit(BETWEEN), F.lit(0))
    parts = texts.select("doc_id", "text_no", "text", found.alias("splits"))
    split = parts.select("doc_id", "text_no", F.posexplode("splits").alias("i", "said")).select("doc_id", "text_no", "i", F.split("said", " ").alias("s"))
    left, mark, right = (F.col("s")[k] for k in range(3))
    asked = split.select("doc_id", "text_no", "i", F.posexplode(F.array(F.concat(left, mark, right), F.concat(left, mark), F.concat(mark, right))).alias("way", "form"))
    asked = asked.select("doc_id", "text_no", "i", "way", canonical(F.col("form")).alias("word"))
    known = vocabulary(native).withColumn("known", F.lit(True))
    each = asked.join(known, ["doc_id", "word"], "left").repartition("doc_id", "text_no").groupBy("doc_id", "text_no", "i").agg(F.coalesce(F.min(F.when(F.col("known"), F.col("way"))), F.lit(1)).alias("way"))
    ways = each.groupBy("doc_id", "text_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "way"))), lambda w: w["way"]).alias("ways"))

    def decided(i: Column) -> Column:
        said, way = F.split(F.get(F.col("splits"), i), " "), F.get(F.col("ways"), i)
        space = lambda here: F.when(here, " ").otherwise("")
        return F.concat(said[0], space(way == 2), said[1], space(F.coalesce(way, F.lit(1)) == 1), said[2])

    joined = F.array_join(F.transform(F.split("text", BETWEEN, -1), lambda gap, i: F.concat(gap, F.coalesce(decided(i), F.lit("")))), "")
    fixed = parts.join(ways, ["doc_id", "text_no"], "left").withColumn("text", F.when(F.size("splits") > 0, joined).otherwise(F.col("text")))
    return fixed.select("doc_id", "text_no", F.regexp_replace("text", TAIL, "$1$2").alias("text"))
