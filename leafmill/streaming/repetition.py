"""What recurs on a document's pages, while its pages arrive in any number of batches.

The batch operators of ``chrome`` count over all pages of a document at once. Here each
document keeps a state - its pages so far, and for each signature the pages that show
it - so that the counts after the last page are those of the batch run, however the
pages were split. Each batch gives the present counts of the documents it touches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leafmill.operators import chrome

KINDS = (*chrome.BANDS, "body", "stamp", "image", "watermark")
COUNTS = "doc_id string, kind string, sig string, on_pages int, n_pages int"


def _by_kind(of) -> Column:
    return F.coalesce(*[F.when(F.col("kind") == kind, of(kind)) for kind in KINDS])


def counted(sightings: DataFrame) -> DataFrame:
    """A stream (doc_id, page, kind, text) to (doc_id, kind, sig, on_pages, n_pages, repeated) of all signatures of the documents that a batch touches.

    A sighting is a line, word, picture or text of a page, by its kind; one with a null
    kind says that there is the page. To be written in update mode: of a document's rows
    those of its last batch hold. Defined cases: a page or sighting that comes again counts
    once; a null doc_id or page counts for nothing.
    """
    seen = sightings.where("doc_id is not null and page is not null")
    signed = seen.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), "kind", _by_kind(lambda kind: chrome.signature(kind, F.col("text"))).alias("sig"))

    def update(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"pages": [], "seen": []}
        pages, shown = set(held["pages"]), {(kind, sig): set(on) for kind, sig, on in held["seen"]}
        for batch in batches:
            pages.update(batch["page"].tolist())
            for page, kind, sig in zip(batch["page"].tolist(), batch["kind"].tolist(), batch["sig"].tolist()):
                if isinstance(kind, str) and isinstance(sig, str):
                    shown.setdefault((kind, sig), set()).add(page)
        state.update((json.dumps({"pages": sorted(pages), "seen": [[kind, sig, sorted(on)] for (kind, sig), on in shown.items()]}),))
        rows = [(key[0], kind, sig, len(on), len(pages)) for (kind, sig), on in shown.items()]
        yield pd.DataFrame(rows, columns=["doc_id", "kind", "sig", "on_pages", "n_pages"])

    counts = signed.groupBy("doc_id").applyInPandasWithState(update, COUNTS, "held string", "update", GroupStateTimeout.NoTimeout)
    return counts.withColumn("repeated", _by_kind(chrome.enough))
