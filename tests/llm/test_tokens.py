import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from leafmill.llm import packing, pieces, token_counts, token_files
from leafmill.llm.tokenizers_fast import JsonTokenizer, json_tokenizer
from tests.llm.common import awkward, docs, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = st.text(st.sampled_from(list("ab Ab.,!'\n\t 0é漢²Σİ▁<|s>\x1c\r")) | st.characters(codec="utf-8"), max_size=60)


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library(path):
    coder, library = JsonTokenizer(path), Tokenizer.from_file(path)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(LETTERS, max_size=5))
    def check(texts):
        for text, (ids, _) in zip(texts, coder.encode(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids

    check()


def test_piece_ids_equal_the_library():
    coder, counter, library = pieces.PieceCoder(PIECES), token_counts.PieceCounter(PIECES), SentencePieceProcessor(model_file=PIECES)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(LETTERS, max_size=4))
    def check(texts):
        for text, ids, n in zip(texts, coder.encode(texts), counter.count(texts)):
            want = library.encode(text)
            assert ids.tolist() == want and n == len(want)
            assert coder.model.decode(want) == library.decode(want)

    check()


def unspaced():
    """Texts without a space: scripts, letters, digits, runs and words."""
    rng = np.random.default_rng(5)
    pick = lambda of, n: "".join(rng.choice(list(of), n))
    return [
        pick([chr(c) for c in range(0x4E00, 0x9FA0)], 9000), pick("的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年", 9000), pick("abcdefghijklmnopqrstuvwxyz", 9000),
        pick("ABCDEFGHIJabcdefghij0123456789+/", 9000), pick(["the", "and", "ing", "er", "tion", "s"], 3000), "=" * 9000, "ab" + "x" * 9001 + "c", "ab" * 4500, "-=" * 3000 + "é" * 3000, pick("ab🙂é\n", 5000),
    ]


@pytest.mark.parametrize("stretch,overlap", [(pieces.STRETCH, pieces.OVERLAP), (61, 24), (7, 16)])
def test_one_lattice_encodes_long_texts_without_spaces(stretch, overlap):
    coder, library = pieces.PieceCoder(PIECES), SentencePieceProcessor(model_file=PIECES)
    coder.lattice = pieces.WindowLattice(coder.model, stretch, overlap)
    for text in unspaced() if stretch > 100 else [t[:1500] for t in unspaced()]:
        assert [ids.tolist() for ids in coder.encode([text, text[:200], "a " + text])] == [library.encode(t) for t in (text, text[:200], "a " + text)]


def test_lanes_commit_within_a_window_of_two_pieces():
    coder = pieces.PieceCoder(PIECES)
    for text in [prose(4, 4000), *unspaced()]:
        coder.lattice.widest = 0
        coder.encode([text])
        assert 0 < coder.lattice.widest <= 2 * coder.model.max_piece, text[:20]


def test_chinese_text_costs_no_more_than_prose():
    """Under 900 CPU seconds a GB, with room for a slow machine."""
    coder = pieces.PieceCoder(PIECES)
    texts = [t * 10 for t in unspaced()[:2]]
    coder.encode(texts)
    began = time.process_time()
    coder.encode(texts)
    assert (time.process_time() - began) / sum(len(t.encode()) for t in texts) < 2500e-9


def test_token_counts(spark):
    rows, library = awkward(), SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, token_counts.count_tokens(docs(spark, rows), PIECES, limit=300).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 300))
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(docs(spark, []), PIECES).count() == 0


def test_pieces_round_trip(spark):
    rows, library = awkward(), SentencePieceProcessor(model_file=PIECES)
    frame = docs(spark, rows)
    got = sorted(map(tuple, pieces.encode_and_check(frame, PIECES).collect()), key=str)
    want = [(d, len(t or ""), len(ids := library.encode(t or "")), crc(ids), True) for d, t, *_ in rows]
    assert got == sorted(want, key=str)
    back = pieces.decode(pieces.encode(frame.where("doc_id = 9 or doc_id = 13"), PIECES), PIECES).collect()
    assert {r.text for r in back} == {t for d, t, *_ in rows if d in (9, 13)}
    assert pieces.encode_and_check(docs(spark, []), PIECES).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_bit_packing(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = token_files.pack_bits(ids, bits)
        assert len(data) == (n * bits + 7) // 8 and (token_files.unpack_bits(data, n, bits) == ids).all()


def test_shard_random_access(tmp_path):
    path, rng = str(tmp_path / "x.lmt"), np.random.default_rng(0)
    own = [rng.integers(0, 5000, n, dtype=np.uint32) for n in (0, 3, 4000, 1, 0, 9000)]
    writer = token_files.ShardWriter(path, token_files.bits_for(5000), 256)
    for k, ids in enumerate(own):
        writer.add(None if k == 4 else k, ids)
    writer.close()
    reader = token_files.ShardReader(path)
    for k in (5, 0, 3, 2, 4, 1):
        assert (reader.document(k) == own[k]).all()
    assert [len(t) for t, _, _ in reader.walk(5000)] == [5, 1]


def test_token_files(spark):
    rows, library = awkward(), Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, token_files.token_file_round_trip(docs(spark, rows), WORDS).collect()), key=lambda r: r[1])
    want, at = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert token_files.token_file_round_trip(docs(spark, []), WORDS).count() == 0


def brute_cost(ends, prices, costs):
    totals = [0, *ends]
    best = [0.0] + [float("inf")] * len(ends)
    for j in range(1, len(totals)):
        for i in range(j):
            n = totals[j] - totals[i]
            if n <= costs.window:
                pad = 0 if n in costs.buckets or n == costs.window else costs.window - n
                best[j] = min(best[j], best[i] + pad + prices[j - 1] + costs.per_sequence)
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.sampled_from([0.0, 3.0, 9.0])), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(atoms):
    costs = packing.PackingCosts(window=64, least_bucket=8, per_sequence=2.0)
    ends = np.cumsum([n for n, _ in atoms]).tolist()
    prices = [p for _, p in atoms]
    cuts = packing.best_cuts(ends, prices, costs)
    cost, at = 0.0, 0
    for c in cuts:
        n = ends[c] - at
        assert 0 < n <= 64
        cost += (0 if n in costs.buckets or n == 64 else 64 - n) + prices[c] + costs.per_sequence
        at = ends[c]
    assert cuts[-1] == len(ends) - 1 and cost == pytest.approx(brute_cost(ends, prices, costs))


@pytest.mark.parametrize("at_once", [60_000, 50])
def test_packing(spark, at_once):
    rows, library = awkward(), Tokenizer.from_file(BYTES)
    frame = docs(spark, rows).coalesce(2)
    got = packing.pack(frame, BYTES, costs=packing.PackingCosts(atoms_at_once=at_once), with_ids=True).collect()
    whole = sorted([*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in rows)
    sequences = defaultdict(list)
    for r in got:
        assert crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length > 0
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].sequence_tokens <= 2048
    # Within a shard pieces follow the documents' order, so joining them gives each document back.
    built, ids = [], []
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.start == len(ids)
        ids += r.ids
        if len(ids) == r.doc_tokens:
            built.append(ids)
            ids = []
    assert not ids and sorted(built) == whole
    padded = sum(s[0].padded_tokens for s in sequences.values())
    assert padded < 1.05 * sum(map(len, whole)) + 2 * 2048
    assert packing.pack(docs(spark, []), BYTES).count() == 0


def test_texts_for_the_library_keep_their_breaks():
    coder, library = json_tokenizer(BYTES), Tokenizer.from_file(BYTES)
    plain = "First one. Second é 漢字 one!\nA line\n\n  another?  The last  "
    (_, want), *_ = coder.encode([plain], breaks=True)
    for text in (f"{plain}<|x", f"{plain}a\u00a0b", plain.replace("one. ", "one.\u00a0"), f"<|endoftext|>{plain}"):
        assert coder.chunks(text) is None
        ((ids, cuts),) = coder.encode([text], breaks=True)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        ended = [library.decode(ids[:c].tolist(), skip_special_tokens=False) for c in cuts.tolist()]
        assert [e.split()[-1] for e in ended][: len(want)] == ["one.", "one!", "line", "another?"] and all(text.startswith(e) for e in ended)
    ((_, cuts),) = coder.encode(["\u00a0" + "Some words here. " * 900 + "\u00a0."], breaks=True)
    places, _ = packing.atoms_of(int(cuts[-1]) + 1, cuts, packing.PackingCosts())
    assert len(places) >= 900 and max(np.diff(places)) < 20
    assert [c.tolist() for _, c in coder.encode(["\u00a0\u00a0", "<|", "", "no end <|"], breaks=True)] == [[], [], [], []]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.lists(st.integers(1, 299), max_size=12)), min_size=1, max_size=60), st.integers(1, 40))
def test_settled_sequences_are_those_of_one_run(documents, at_once):
    def packed(n):
        costs = packing.PackingCosts(window=64, least_bucket=8, per_sequence=2.0, atoms_at_once=n)
        shard, rows = packing._Shard(0, costs), []
        for k, (size, breaks) in enumerate(documents):
            rows += shard.add(k, np.arange(size, dtype=np.uint32), np.unique(np.array(breaks, np.int64)))
        early = len(rows)
        return [r[:9] for r in rows + shard.solve(True)], early

    whole, _ = packed(10**9)
    assert packed(at_once)[0] == whole


@pytest.mark.parametrize("sizes", [(1, 2000), (1023, 1024)])
def test_waiting_documents_stay_bounded(sizes):
    rng, costs = np.random.default_rng(5), packing.PackingCosts(atoms_at_once=500, atoms_at_most=4000)
    shard, given_out, total = packing._Shard(0, costs), 0, 0
    for k in range(9000 if sizes[0] > 1 else 900):
        n = int(rng.integers(*sizes))
        given_out += sum(r[2] for r in shard.add(k, np.zeros(n, np.uint32), np.unique(rng.integers(1, n + 1, n // 20)) if sizes[0] == 1 else np.zeros(0, np.int64)))
        total += n
        assert len(shard.ends) < costs.atoms_at_most + 200
    assert given_out > 0.5 * total


def test_newer_letters_and_long_white_space():
    texts = [":\U0003d000 a", "xᲉy ՘. 1ვ0", "a   b\n\n\n c  \n", "tail   ", " 　 x   ", "ΑΣ Σ'S don't", "<|endoftext|><|startoftext|> <|endoftext|>"]
    for path in (BYTES, WORDS):
        coder, library = JsonTokenizer(path), Tokenizer.from_file(path)
        for text, (ids, _) in zip(texts, coder.encode(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, (path, text)


def test_unigram_models_take_the_best_score_sum(tmp_path):
    """A model written by hand, as none of the public ones is of this kind."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix = "identity", True
    proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.escape_whitespaces = False, True
    kinds = {"<unk>": 2, "<s>": 3, "</s>": 3}
    scored = {"▁": -2.0, "a": -3.0, "b": -3.1, "c": -3.7, "ab": -4.0, "bc": -3.9, "abc": -6.5, "▁ab": -4.4, "▁a": -3.5, "cab": -5.1}
    for piece, score in [*((p, 0.0) for p in kinds), *scored.items()]:
        proto.pieces.add(piece=piece, score=score, type=kinds.get(piece, 1))
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as out:
        out.write(proto.SerializeToString())
    coder, library, rng = pieces.PieceCoder(path), SentencePieceProcessor(model_file=path), np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abc "), n)) for n in rng.integers(0, 60, 80)] + ["abcab " * 90, ""]
    assert [ids.tolist() for ids in coder.encode(texts)] == [library.encode(t) for t in texts]


def test_groups_are_balanced_by_bytes():
    import pyarrow as pa

    from leafmill.llm.chunks import grouped

    batch = pa.RecordBatch.from_arrays([pa.array(["漢" * 10, None, "a" * 20, "b" * 200, "é"])], ["text"])
    assert [texts for _, texts in grouped([batch], "text", 50)] == [["漢" * 10, "", "a" * 20], ["b" * 200], ["é"]]
