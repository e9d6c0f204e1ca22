"""A document split over three batches against the batch operators on all of its pages."""

from pyspark.sql import functions as F

from leafmill.operators import chrome
from leafmill.streaming import repetition

SIGHTING = "doc_id string, page int, kind string, text string"


def sightings():
    rows = []
    for page in range(1, 25):
        rows += [("long", page, None, None), ("long", page, "top", f"Report  {page}"), ("long", page, "bottom", f"page {page} of 24"), ("long", page, "body", "the same long line" if page % 4 == 0 else f"line {page} of its own")]
        rows += [("long", page, "top", "REPORT 0"), ("long", page, "body", "short")] + ([("long", page, "stamp", "Draft" if page % 2 else "DRAFT")] if page < 6 else []) + ([("long", page, "image", "7")] if page % 2 else [("long", page, "image", str(page))])
    for page in range(1, 4):
        rows += [("short", page, None, None), ("short", page, "left", "Side"), ("short", page, "watermark", "a watermark" if page < 3 else "another one"), ("short", page, "watermark", "wm")]
    return rows + [(None, 1, "top", "x"), ("short", None, "top", "x"), ("short", 2, "left", "side"), ("short", 2, None, None)]


def test_pages_of_three_batches_agree_with_one_run(spark, tmp_path):
    rows = sightings()
    for k in range(3):  # a document's pages arrive out of order
        spark.createDataFrame(rows[k::3], SIGHTING).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    latest = {}

    def keep(batch, number):
        found = {}
        for r in batch.collect():
            found.setdefault(r.doc_id, {})[r.kind, r.sig] = (r.on_pages, r.n_pages, r.repeated)
        latest.update(found)

    stream = spark.readStream.schema(SIGHTING).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = repetition.counted(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).foreachBatch(keep).trigger(availableNow=True).start()
    assert query.awaitTermination(300) and len([p for p in query.recentProgress if p["numInputRows"]]) == 3

    frame = spark.createDataFrame(rows, SIGHTING).where("doc_id is not null and page is not null")
    counts = frame.groupBy("doc_id").agg(F.countDistinct("page").cast("int").alias("n_pages"))
    of = lambda kind, name="text": frame.where(F.col("kind") == kind).withColumnRenamed("text", name)
    placed = lambda kind: of(kind, "line").withColumns({"band": F.lit(kind), "block_no": F.lit(0), "line_no": F.lit(0)})
    want = set()
    for kind in chrome.BANDS:
        kept = chrome.repeated_band_lines(placed(kind), counts).select("doc_id", chrome.signature(kind, F.col("line")).alias("sig"), "on_pages")
        want |= {(r.doc_id, kind, r.sig, r.on_pages) for r in kept.collect()}
    kept = chrome.repeated_body_lines(of("body", "line").withColumn("idx", F.lit(0)), counts).select("doc_id", chrome.signature("body", F.col("line")).alias("sig"), "on_pages")
    want |= {(r.doc_id, "body", r.sig, r.on_pages) for r in kept.collect()}
    for kind, found in (("stamp", chrome.repeated_vertical_words(of("stamp"), counts)), ("image", chrome.repeated_images(of("image", "xref"), counts)), ("watermark", chrome.watermark_signatures(of("watermark"), counts))):
        want |= {(r[0], kind, r[1], r.on_pages) for r in found.collect()}
    got = {(doc, kind, sig, on) for doc, own in latest.items() for (kind, sig), (on, _, repeated) in own.items() if repeated}
    assert got == want and {kind for _, kind, *_ in want} == {"top", "bottom", "left", "body", "stamp", "image", "watermark"}
    assert {doc: {n for _, n, _ in own.values()} for doc, own in latest.items()} == {"long": {24}, "short": {3}}
