"""Secret scans with corpus-wide ownership frequency, in DataFrame and SQL functions only.

Base spans are the leftmost matches of three patterns in each whole text. Their values
are hashed and counted over the corpus by distinct owners and repositories: a value
that many owners hold in documents of their own, none of them in more than half of
the value's repositories, is a copied example; one that looks random is a live-looking
credential until then; any other is plain. Near copies of one document count as one
document. A live or an example verdict adds a span over the value; base spans stay.

Positions come from splitting a text by its pattern: the gaps and the matches,
measured in code points one after another, say where each match starts. Texts are
scanned once and dropped; what travels is one narrow row per document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.runtime import cut

# Fixed values of the contract.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A maximal run holds every match that starts inside it, so a run of the least length is the pattern itself, filtered.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_ASSIGN = 8
KINDS = ("assign", "access", "hex", "live", "example")
PLAIN, LIVE, EXAMPLE = -1, 3, 4
#: Matches of one text that are placed together.
STEP = 512
SPAN = "array<struct<start:int,ord:int,end:int,from:int,value:string>>"


@dataclass(frozen=True)
class OwnershipConfig:
    #: An example belongs to so many owners and documents at least.
    example_owners: int = 3
    #: Live-looking values have so many characters, a digit and so many distinct characters.
    live_length: int = 16
    live_distinct: int = 8
    #: Documents that agree on over half of so many least hashes of five-word shingles count as one.
    hashes: int = 9


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _spans(text: str, pattern: str, kind: int, value_group: int, least_value: int) -> str:
    """SQL: the pattern's matches in ``text`` as spans whose value (a group at the match's end) is long enough.

    Matches are taken ``STEP`` at a time: the sums of the steps say where each one begins,
    so a text of many matches costs no more than in proportion.
    """
    quoted = _quoted(pattern)
    all_ = f"regexp_extract_all({text}, '{quoted}', 0)"
    zipped = f"arrays_zip(slice(split({text}, '{quoted}', -1), 1, size({all_})), {all_}, regexp_extract_all({text}, '{quoted}', {value_group}))"
    found = f"transform({zipped}, x -> named_struct('gap', length(x.`0`), 'size', length(x.`1`), 'value', x.`2`))"
    # transform(array(x), y -> ...)[0] gives x a name, so that it is computed once.
    steps = f"transform(array({found}), f -> transform(filter(sequence(0, size(f)), i -> i % {STEP} = 0 and i < size(f)), i -> slice(f, i + 1, {STEP})))[0]"
    sums = "transform(steps, step -> aggregate(step, 0, (n, x) -> n + x.gap + x.size))"
    firsts = f"aggregate({sums}, named_struct('at', 0, 'out', cast(array() as array<int>)), (acc, n) -> named_struct('at', acc.at + n, 'out', array_append(acc.out, acc.at)), acc -> acc.out)"
    end = "acc.at + x.gap + x.size"
    span = f"named_struct('start', acc.at + x.gap, 'ord', {kind}, 'end', {end}, 'from', {end} - length(x.value), 'value', x.value)"
    each = f"aggregate(part, named_struct('at', base, 'out', cast(array() as {SPAN})), (acc, x) -> named_struct('at', {end}, 'out', array_append(acc.out, {span})), acc -> acc.out)"
    spans = f"transform(array({steps}), steps -> flatten(zip_with(steps, {firsts}, (part, base) -> {each})))[0]"
    return f"filter({spans}, s -> length(s.value) >= {least_value})"


def base_spans(text: str = "text") -> Column:
    """All base spans of a text, by start and then kind; an empty array where there are none."""
    some = []
    for pattern, kind, group, least in ((ASSIGN, 0, 2, LEAST_ASSIGN), (ACCESS, 1, 0, 1), (HEX, 2, 0, 1)):
        some.append(f"if({text} rlike '{_quoted(pattern)}', {_spans(text, pattern, kind, group, least)}, cast(array() as {SPAN}))")
    return F.expr(f"array_sort(concat({', '.join(some)}))")


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["ord"]], s["start"], s["end"])), ",")


def _with_sketch(rows: DataFrame, text: str, config: OwnershipConfig) -> DataFrame:
    """``rows`` with the least shingle hashes of the column ``text`` where the row has base spans; the text goes."""
    words = F.when(F.size("base") > 0, F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))
    shingle = lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i + 1, 5)))
    hashed = F.when(F.size("words") <= 5, F.array(F.xxhash64(F.concat_ws(" ", "words")))).otherwise(F.transform(F.sequence(F.lit(0), F.size("words") - 5), shingle))
    least = [F.array_min(F.transform("hashed", lambda h, k=k: F.xxhash64(h, F.lit(k)))) for k in range(config.hashes)]
    # Columns that are used more than once keep their own step, so nothing is computed twice.
    kept = [c for c in rows.columns if c != text]
    return rows.select(*kept, words.alias("words")).select(*kept, hashed.alias("hashed")).select(*kept, F.array(*least).alias("sketch"))


def verdicts(candidates: DataFrame, config: OwnershipConfig) -> DataFrame:
    """(digest, owners, repositories, verdict) of every value in ``candidates`` (digest, owner, repository, sketch, random)."""
    # Distinct rows first: a value that a third of all rows copy is combined before the shuffle.
    holders = candidates.select("digest", "random", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).distinct()
    owners = holders.groupBy("digest", "random", "owner").agg(F.count("*").alias("repositories"))
    counted = owners.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("repositories").alias("most"), F.max("random").alias("random"))
    # Each hash tells documents apart, near copies mostly not; the median over the hashes is the number of documents.
    apart = candidates.select("digest", F.posexplode("sketch").alias("k", "least")).distinct().groupBy("digest", "k").agg(F.count("*").alias("n"))
    documents = apart.groupBy("digest").agg(F.sort_array(F.collect_list("n"))[config.hashes // 2].alias("documents"))
    counted = counted.join(documents, "digest")
    example = (F.least("owners", "documents") >= config.example_owners) & (2 * F.col("most") <= F.col("repositories"))
    return counted.select("digest", "owners", "repositories", F.when(example, EXAMPLE).when(F.col("random"), LIVE).otherwise(PLAIN).alias("verdict"))


def _looks_random(value: Column, config: OwnershipConfig) -> Column:
    return (F.length(value) >= config.live_length) & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= config.live_distinct)


def added_spans(scanned: DataFrame, config: OwnershipConfig, wanted: Column | None = None) -> DataFrame:
    """(row, added) for rows (row, owner, repository, sketch, base) that hold at least one value with a wanted verdict, live or example if not said."""
    wanted = F.col("verdict") != PLAIN if wanted is None else wanted
    each = scanned.select("row", "owner", "repository", "sketch", F.explode("base").alias("s"))
    each = each.select("row", "owner", "repository", "sketch", F.sha2("s.value", 256).alias("digest"), _looks_random(F.col("s.value"), config).alias("random"), F.col("s.from").alias("start"), F.col("s.end").alias("end"))
    judged = each.join(verdicts(each, config).where(wanted).select("digest", "verdict"), "digest")
    span = F.struct(F.col("start"), F.col("verdict").alias("ord"), F.col("end"))
    return judged.groupBy("row").agg(F.array_sort(F.collect_set(span)).alias("added"))


def scan(docs: DataFrame, owner: Column | None = None, repository: Column | None = None, config: OwnershipConfig | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example of every row.

    Defined cases: a null text counts as empty; null owners and repositories are one
    unknown each; repeated rows are scanned one by one (and count once for ownership);
    a null doc_id stays null; an empty table gives no rows; by default the owner is
    ``source`` and the repository ``source`` with ``lang``.
    """
    config = config or OwnershipConfig()
    owner = F.col("source").cast("string") if owner is None else owner
    repository = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")) if repository is None else repository
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), owner.alias("owner"), repository.alias("repository"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = cut(_with_sketch(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", "text", base_spans().alias("base")), "text", config))
    none = scanned.where("size(base) = 0").select("doc_id", "base", F.expr("cast(array() as array<struct<start:int,ord:int,end:int>>)").alias("added"))
    held = scanned.where("size(base) > 0")
    some = held.join(added_spans(held, config), "row", "left").select("doc_id", "base", "added")
    both = none.unionByName(some)
    narrow = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end")))
    added = F.coalesce("added", F.expr("cast(array() as array<struct<start:int,ord:int,end:int>>)"))
    count = lambda a, k: F.size(F.filter(a, lambda s: s["ord"] == k)).cast("long")
    return both.select(
        "doc_id",
        count("base", 0).alias("n_assign"),
        count("base", 1).alias("n_access"),
        count("base", 2).alias("n_hex"),
        F.sha2(_said(F.col("base")), 256).alias("base_sha256"),
        _said(F.array_sort(F.concat(narrow, added))).alias("spans"),
        count(added, 3).alias("n_live"),
        count(added, 4).alias("n_example"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", owner: Column | None = None, repository: Column | None = None, config: OwnershipConfig | None = None) -> DataFrame:
    """The documents with the values of all base spans but proven examples replaced by ``mark``, and n_chars brought up to date.

    Values that overlap go as one. Defined cases: all columns and rows are kept,
    whatever their names; a row that holds no base span, and so a null or empty text,
    passes through untouched; repeated rows are treated alike; an empty table gives no rows.
    """
    config = config or OwnershipConfig()
    owner = F.col("source").cast("string") if owner is None else owner
    repository = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")) if repository is None else repository
    columns = docs.columns
    spans = base_spans("text")
    suspect = F.expr("coalesce(" + " or ".join(f"text rlike '{_quoted(p)}'" for p in (ASSIGN, ACCESS, HEX)) + ", false)")
    whole = F.struct(*[docs[c] for c in columns])
    held = docs.where(suspect).select(F.monotonically_increasing_id().alias("row"), owner.alias("owner"), repository.alias("repository"), whole.alias("doc"), F.col("text").alias("scanned"), spans.alias("base"))
    held = cut(_with_sketch(held, "scanned", config))
    found = held.join(added_spans(held, config, F.col("verdict") != EXAMPLE), "row", "left")
    found = found.select("doc", F.coalesce("added", F.expr("cast(array() as array<struct<start:int,ord:int,end:int>>)")).alias("live"))
    # Spans are taken STEP at a time, each step on its own part of the text, so that very many cost no more than in proportion.
    quoted = mark.replace("\\", "\\\\").replace("'", "\\'")
    one = f"named_struct('at', greatest(a.at, s.end), 'out', if(s.start >= a.at, concat(a.out, substring(own, a.at - acc.at + 1, s.start - a.at), '{quoted}'), a.out))"
    step = f"transform(array(substring(doc.text, acc.at + 1, array_max(transform(part, s -> s.end)) - acc.at)), own -> aggregate(part, named_struct('at', acc.at, 'out', ''), (a, s) -> {one}))[0]"
    parts = f"transform(filter(sequence(0, size(live)), i -> i % {STEP} = 0 and i < size(live)), i -> slice(live, i + 1, {STEP}))"
    whole_text = f"transform(array({step}), b -> named_struct('at', b.at, 'out', concat(acc.out, b.out)))[0]"
    text = F.expr(f"aggregate({parts}, named_struct('at', 0, 'out', ''), (acc, part) -> {whole_text}, acc -> concat(acc.out, substring(doc.text, acc.at + 1)))")
    found = found.select("doc", "live", F.when(F.size("live") > 0, text).otherwise(F.col("doc.text")).alias("new_text"))
    fields = []
    for c in columns:
        old = F.col("doc").getField(c)
        if c == "text":
            fields.append(F.col("new_text").alias(c))
        elif c == "n_chars":
            fields.append(F.when(F.size("live") > 0, F.length("new_text")).otherwise(old).cast(docs.schema[c].dataType).alias(c))
        else:
            fields.append(old.alias(c))
    return docs.where(~suspect).unionByName(found.select(*fields))
