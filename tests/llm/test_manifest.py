import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import pytest

from leafmill.llm import filter_audit, language_id, merkle
from tests.llm.common import awkward, docs, prose

# --- filter audit ---------------------------------------------------------------------------------------------------


def audit_rows():
    rows = [(d, t, [None, "", "en", "de"][i % 4], f"s{i % 3}") for i, (d, t) in enumerate(awkward())]
    rows += [(100 + i, prose(100 + i % 7, 250 - 100 * (i % 2)) + ["", " $1", " " + "ABC " * 30][i % 3], "en", "s") for i in range(40)]
    rows += [(200 + i, prose(5, 300), ["en", "fr"][i % 2], "s") for i in range(6)] + [(200, prose(5, 300), "en", "s"), (None, prose(5, 300), "fr", "s")]
    rows += [(300 + i, "say it " * 150, "fr", "s") for i in range(3)] + [(None, None, None, "s")]
    return rows


def plain_audit(rows, labels):
    words = lambda t: [w.decode() for w in (t or "").encode().split()]  # noqa: E731  bytes know the six white characters alone
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    seen = []
    for d, t, lang, _ in rows:
        own, text = words(t), t or ""
        fails = {
            "A": len(own) < 200, "B": 100 * len(set(own)) < 50 * len(own), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": d is not None and any(e is not None and e < d and (u or "") == text for e, u, *_ in rows),
        }
        seen.append((lang or "", fails, d in good, d in toxic))
    out = {}
    for part in {s[0] for s in seen}:
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                own = [(f, next((i for i, x in enumerate(order, 1) if f[x]), 9), g, x) for p, f, g, x in seen if p == part]
                out[part, order, step] = (
                    sum(at > step for _, at, *_ in own), sum(at == step for _, at, *_ in own), sum(f[letter] and at < step for f, at, *_ in own),
                    sum(f[letter] and sum(f.values()) == 1 for f, *_ in own), sum(at == step and g for _, at, g, _ in own), sum(at == step and x for _, at, _, x in own),
                )
    total = {}
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    rows = audit_rows()
    labels = [(d, int(d % 3 > 0), int(d % 5 == 0)) for d, *_ in rows if d is not None and d % 4] + [(201, 0, 1), (201, 1, None), (None, 1, 1), (9_999, 1, 1)]
    frame = filter_audit.audit(docs(spark, rows), spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, text string"))
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in frame.collect()}
    assert got == plain_audit(rows, labels) and len(got) == frame.count()


def test_filter_audit_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs(spark, []), labels).count() == 0
    assert filter_audit.audit(docs(spark, [(1, "a")]), labels).count() == 600


# --- language ID ----------------------------------------------------------------------------------------------------

SOUNDS = {"aa": ("ka", "lo", "mi"), "bb": ("sch", "tzu", "über"), "cc": ("漢", "字", "語彙")}


def spoken(seed, language, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SOUNDS[language]) for _ in range(3)).capitalize() + rng.choice(["", ".", " 12", "!"]) for _ in range(words))


def spoken_rows():
    rows = [(i, spoken(i, name, 5 + i % 60), name, "s") for i in range(150) for name in [("aa", "bb", "cc")[i % 3]]]
    rows += [(1000 + i, t, "bb", "s") for i, t in enumerate((None, "", "12 % ½ ²", "́ ́"))]
    rows += [(None, spoken(1, "aa", 9), "bb", "s"), (7, spoken(7, "bb", 30), "bb", "s"), (7, spoken(7, "bb", 30), "bb", "s"), (2000, spoken(8, "cc", 9), None, "s"), (2001, "x" * 600_000 + " " + spoken(9, "bb", 40_000), None, "s")]
    return rows


def test_language_id(spark):
    rows = spoken_rows()
    got = language_id.language_id(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    right = {(d, t): name for d, t, name, _ in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.doc_id is not None and 1000 <= r.doc_id < 2000:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 1000:
            assert r.lang_pred in {name for (d, _), name in right.items() if d == r.doc_id}
    named = {r.doc_id: r.lang_pred for r in got}
    assert named[None] == "aa" and named[2000] == "cc" and named[2001] == "bb"


def plain_grams(text, longest):
    """N-grams by slicing: those of each word with a space on either side, without the lone space."""
    import regex

    for word in regex.findall(r"[\p{L}\p{M}]+", text.lower()):
        padded = f" {word} "
        for n in range(1, longest + 1):
            yield from (padded[i : i + n] for i in range(len(padded) - n + 1) if padded[i : i + n].strip(" "))


@pytest.mark.parametrize("stretch", [1 << 18, 7])
def test_scores_are_sums_over_all_n_grams(spark, stretch):
    rows = spoken_rows()[:60]
    config = language_id.LanguageConfig(bits=12, stretch=stretch)
    model = language_id.train(docs(spark, rows), config)
    slot = {}

    def slot_of(gram):
        if gram not in slot:
            h = 0
            for c in gram:
                h = (h * 0x100000001B3 + ord(c) + 1) % 2**64
            slot[gram] = (((h ^ len(gram)) * 0x9E3779B97F4A7C15) % 2**64) >> (64 - model.bits)
        return slot[gram]

    counts = np.zeros((3, 1 << model.bits))
    sizes = np.zeros(3)
    for d, t, name, _ in rows:
        if zlib.crc32(str(d).encode()) % 4 != 2:
            sizes[model.languages.index(name)] += 1
            for g in plain_grams(t, 4):
                counts[model.languages.index(name), slot_of(g)] += 1
    share = np.log((counts + config.alpha) / (counts.sum(1, keepdims=True) + config.alpha * (1 << model.bits)))
    assert np.array_equal(model.log_likelihood, np.rint(share * language_id.UNIT).astype(int))
    assert np.array_equal(model.log_prior, np.rint(np.log(sizes / sizes.sum()) * language_id.UNIT).astype(int))
    texts = [t for _, t, *_ in rows] + ["", "Kaka, lolo-mi."]
    want = [sum((model.log_likelihood[:, slot_of(g)].astype(int) for g in plain_grams(t, 4)), model.log_prior) for t in texts]
    assert np.array_equal(model.scores(texts)[0], np.array(want))


def test_language_id_fit_is_bounded_and_needs_no_labels(spark):
    rows = spoken_rows()
    same = docs(spark, rows + [(7, t, n, s) for d, t, n, s in rows if d == 7] * 300)
    config = language_id.LanguageConfig(max_rows=10)
    assert np.array_equal(language_id.train(same, config).log_likelihood, language_id.train(same.repartition(13), config).log_likelihood)
    assert language_id.train(same, language_id.LanguageConfig(max_languages=2)).languages == ["aa", "bb"]
    assert language_id.slot_bits(512, config) == 12 and language_id.slot_bits(4, config) == 16
    nameless = docs(spark, [(1, "some text", None, "s")])
    assert [(r.lang_pred, r.score) for r in language_id.language_id(nameless).collect()] == [("und", 0.0)]
    assert language_id.language_id(docs(spark, [])).count() == 0


def test_language_id_on_held_out_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in frame.collect()}
    held = [r for r in language_id.language_id(frame).collect() if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


# --- Merkle manifest ------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """All levels, and for every leaf the runs of siblings as (left, right) texts."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            run = level[i // 2 * 2 : i // 2 * 2 + 2]
            path.append(("".join(run[: i % 2]), "".join(run[i % 2 + 1 :])))
            i //= 2
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((plain_leaf(r), r))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    inner = {n: sorted(trees[n], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])) for n in names}
    built = {n: plain_tree([h for h, _ in inner[n]]) for n in names}
    root, outer = plain_tree([built[n][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for (leaf, r), path in zip(inner[n], built[n][1]):
            path = path + outer[k]
            now = leaf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                now = plain_leaf((r[0], r[1], r[2], r[3] + 1, r[4]))
            for left, right in path:
                now = sha(left + now + right)
            out.append((r[0], leaf, built[n][0], root, sha("".join(a + b for a, b in path)), now, now == root))
    return out


def manifest_rows(n):
    names = [None, "", "en", "en", "en", "de", "ü"]
    rows = [(i % (n - 5 or 1) if i % 11 else None, None if i % 13 == 0 else f"s{i % 3}", names[i % 7], None if i % 5 == 0 else i, None if i % 17 == 0 else prose(i % 9, i % 20)) for i in range(n)]
    return rows + rows[:3] + [(2**62, "s", "solo", 2**63 - 1, "é$'")]


@pytest.mark.parametrize("n,bits", [(0, 2), (1, 2), (9, 1), (40, 1), (150, 2), (150, 13)])
def test_manifest(spark, n, bits):
    rows = manifest_rows(n) if n else [(3, "s", "x", 1, "alone")]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos long, tree string").repartition(5)
    got = merkle.manifest(frame, merkle.MerkleConfig(bits=bits))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_manifest(rows), key=str)
    assert any(r[-1] for r in plain_manifest(rows)) and (n < 9 or not all(r[-1] for r in plain_manifest(rows)))


def test_manifest_without_rows_and_broadcast(spark):
    assert merkle.manifest(docs(spark, [])).count() == 0
    rows = manifest_rows(60)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(frame, merkle.MerkleConfig(bits=3, small=0))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_manifest(rows), key=str)
