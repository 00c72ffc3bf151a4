import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from modelvigil.llm import packing, token_file, tokens
from tests.llm.frames import clashing, documents

BYTE, WORD = tokens.default_path("byte_bpe_50k.json"), tokens.default_path("word_bpe_49k.json")
ALPHABET = [
    " ", "  ", "\n", "\n\n", "\t", "a", "b", "é", "ß", "É", "'s", "'S", "'", "1", "42", "!", ".", "…", "\x1c", "\x85",
    "\xa0", " ", "Σ", "́", "İ", "ẞ", "K", "漢", "Foo", "<|endoftext|>", "\x00", "²", "ª", "_", "×",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.lists(st.sampled_from(ALPHABET), max_size=12), max_size=6))
def test_ids_are_the_librarys(path, parts):
    texts = ["".join(p) for p in parts]
    encode = tokens.encoder(path)
    assert encode.encode(texts) == encode.whole(texts)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_are_the_librarys(path):
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>é", "漢 <|endoftext|>", "<|ENDOFTEXT|> x", "<|startoftext|> a", "plain"]
    fresh = Tokenizer.from_file(path)
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in tokens.PieceEncoder(path).encode(texts)]
    assert got == [fresh.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_with_a_small_memory(spark, path):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    small = tokens.PieceEncoder(path, memory=60_000, longest=6)
    sizes = []
    ids = [code for doc in docs for code in (small.encode([doc])[0], sizes.append(small.held))[:1]]
    assert ids == small.whole(docs)
    largest = max(len(set(d.split())) for d in docs)
    assert max(sizes) <= 60_000 + 2 * largest * 210 and len(small.known) <= max(sizes) / 180


def reference(text, path, end):
    encode = tokens.encoder(path)
    return np.append(np.frombuffer(encode.whole([text or ""])[0], dtype="<u4"), end).astype("<u4")


def test_worker_keeps_one_state():
    from modelvigil.llm import common, secrets

    first = tokens.encoder(BYTE)
    first.encode(["some words here"])
    assert tokens.encoder(BYTE) is first and first.known
    secrets.vocabulary(tokens.default_path("byte_bpe_50k.tiktoken"))
    assert len(common._STATE) == 1
    assert tokens.encoder(WORD) is not first and len(common._STATE) == 1
    common.release_worker_memory()
    assert not common._STATE


CASES = [
    (5, None), (1, ""), (2, "a b c"), (2, "a b c"), (3, "word " * 9_000), (4, "Ünïcode 漢字 <|endoftext|>  \n x"), (None, "no id"),
    (-7, "x" * 5_000), *[(100 + i, "tie of words") for i in range(40)],
]


@settings(max_examples=150, deadline=None)
@given(
    lengths=st.lists(st.one_of(st.integers(1, 40), st.integers(1, 400)), max_size=60), slack=st.sampled_from([0, 3]),
    tiers=st.sampled_from([(64, 32, 16, 8, 4, 2, 1), (64, 16)]),
)
def test_pack_covers_every_token_once(lengths, slack, tiers):
    found = packing.pack(lengths, tiers, slack)
    pieces = defaultdict(list)
    for sequence in found:
        assert 0 < sum(p[2] for p in sequence) <= tiers[0]
        for doc, start, length in sequence:
            assert length > 0
            pieces[doc].append((start, length))
    for doc, length in enumerate(lengths):
        at = 0
        for start, size in sorted(pieces[doc]):
            assert start == at
            at += size
        assert at == length
    if slack == 0:  # no padding at all
        assert all((total := sum(p[2] for p in s)) & (total - 1) == 0 for s in found)
    groups = packing.step_groups(found, tiers, 4)
    loads = Counter()
    for group, sequence in zip(groups, found):
        loads[group] += sum(p[2] for p in sequence)
    # A step is full but for one sequence at most.
    assert len(groups) == len(found) and max(loads.values(), default=0) <= 5 * tiers[0]
    assert len(loads) <= max(1, -(-sum(loads.values()) // (4 * tiers[0])))


def test_tiers_have_windows_of_their_own():
    rng = np.random.default_rng(7)
    lengths = np.minimum(rng.geometric(1 / 300, 3_000), 9_000).tolist()
    found = packing.pack(lengths)
    sizes = Counter(sum(p[2] for p in s) for s in found)
    assert all(sizes[t] > 20 for t in packing.TIERS) and sum(sizes[t] for t in packing.TIERS) > len(found) - 12
    cut = Counter(doc for s in found for doc, _, _ in s)
    assert sum(n > 1 for doc, n in cut.items() if lengths[doc] <= 2048) < 0.1 * len(lengths)
    # Ends are in the tier that their length routes them to, unless they fill a longer window or are cut.
    for s in found:
        longest = max(p[2] for p in s)
        assert longest > sum(p[2] for p in s) // 4 or len(s) > 1


def test_step_groups_have_like_costs():
    rng = np.random.default_rng(2)
    sequences = packing.pack(np.minimum(rng.geometric(1 / 500, 4_000), 9_000).tolist())
    groups = np.array(packing.step_groups(sequences))
    tokens_ = np.bincount(groups, [sum(p[2] for p in s) for s in sequences])
    costs = np.bincount(groups, [sum(p[2] ** 2 for p in s) for s in sequences])
    assert len(tokens_) > 40 and tokens_.max() <= 16 * 2048 + 2048 and tokens_.max() - tokens_.min() <= 2048
    assert costs.max() < 1.25 * costs.min()
    tiers = [Counter(sum(p[2] for p in s) for s, g in zip(sequences, groups) if g == step) for step in range(len(tokens_))]
    assert all(len(t) >= 3 for t in tiers)  # every step mixes tiers


def check_pieces(rows, texts):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        whole = reference(texts[r.doc_id], BYTE, 1)
        part = whole[r.start : r.start + r.length].tobytes()
        assert (zlib.crc32(part), len(whole)) == (r.ids_crc32, r.doc_tokens)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and own[0].tier >= at
    return by_doc


def test_packed_pieces(spark):
    docs = clashing(documents(spark, CASES)).repartition(3)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = packing.pack_documents(docs, BYTE, batch_docs=7).collect()
    by_doc = check_pieces(rows, {d: t for d, t in CASES})
    assert set(by_doc) == {d for d, _ in CASES}
    for doc, pieces in by_doc.items():
        times = sum(d == doc for d, _ in CASES)
        assert sum(r.length for r in pieces) == times * pieces[0].doc_tokens
    assert all(r.ids == reference(dict(CASES)[r.doc_id], BYTE, 1)[r.start : r.start + r.length].tobytes() for r in rows)
    assert packing.pack_documents(documents(spark, []), BYTE).count() == 0


def test_packing_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = packing.op4_packing(spark, folder).collect()
    by_doc = check_pieces(rows, texts)
    assert set(by_doc) == set(texts)
    assert all(sum(r.length for r in pieces) == pieces[0].doc_tokens for pieces in by_doc.values())
    totals = defaultdict(int)
    for r in rows:
        totals[r.sequence_id] += r.length
    assert sum(2048 - t for t in totals.values() if t & (t - 1)) == 0


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), cut=st.integers(0, 9))
def test_token_file_round_trip(ids, cut):
    lengths = [len(ids) * k // 10 - len(ids) * (k - 1) // 10 for k in range(1, 11)]
    names = [None if k == cut else k for k in range(10)]
    data = token_file.encode_file(np.array(ids, dtype="<u4"), names, lengths)
    reads = []

    def read_at(offset, size):
        reads.append(size)
        return data[offset : offset + size]

    file = token_file.TokenFile(read_at)
    assert file.all_tokens().tolist() == ids
    found, starts = file.documents()
    assert found == names and np.diff(starts).tolist() == lengths
    for place in range(0, len(ids), 97):
        reads.clear()
        assert file.token(place) == ids[place]
        assert sum(reads) <= 4 * (1 + token_file.RANK_BITS // 8 + 8)  # a few bytes a level
    with pytest.raises(IndexError):
        file.token(len(ids))


def test_token_file_refuses_other_files():
    with pytest.raises(ValueError):
        token_file.TokenFile(lambda at, n: struct.pack("<8sIIQQ", b"PARQUET!", 8, 1, 0, 0)[at : at + n])


def test_token_files_of_documents(spark, tmp_path):
    docs = clashing(documents(spark, CASES))
    folder = str(tmp_path / "ids")
    token_file.write_token_files(docs, folder, WORD, file_tokens=50, partitions=3)
    rows = token_file.read_token_files(spark, folder).collect()
    want, at = [], 0
    for doc, text in sorted(CASES, key=lambda c: (c[0] is not None, c[0] or 0, c[1] or "")):
        ids = reference(text, WORD, 2)
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    assert spark.read.parquet(f"{folder}/manifest").count() > 5
    files = spark.read.parquet(f"{folder}/manifest").count()
    assert files > 1 and token_file.read_token_files(spark, folder).rdd.getNumPartitions() == min(files, token_file.READ_TASKS)
    none = str(tmp_path / "none")
    token_file.write_token_files(documents(spark, []), none, WORD)
    assert token_file.read_token_files(spark, none).count() == 0


def test_random_access_reads_single_tokens(spark, tmp_path):
    folder = str(tmp_path / "ids")
    token_file.write_token_files(documents(spark, [(1, "one two three"), (2, "vier fünf")]), folder, WORD, partitions=1)
    path = spark.read.parquet(f"{folder}/manifest").first().path
    file, handle = token_file.open_file(path)
    with handle:
        want = [*reference("one two three", WORD, 2), *reference("vier fünf", WORD, 2)]
        assert [file.token(i) for i in range(file.n_tokens)] == want


def test_token_file_query(spark):
    folder = "/root/testdata/sf0.001"
    at = 0
    found = {r.doc_id: r for r in token_file.op9_token_file(spark, folder).collect()}
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = reference(r.text, WORD, 2)
        got = found.pop(r.doc_id)
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not found


def test_words_of_a_large_vocabulary_are_merged_once():
    encoder = tokens.PieceEncoder(tokens.default_path("byte_bpe_50k.json"))
    merged, merge = [], encoder.merged
    encoder.merged = lambda parts: merged.extend(parts) or merge(parts)
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(str(i).translate(letters) for i in range(a, a + 1_000)) for a in range(0, 300_000, 1_000)]
    first = list(encoder.stream(texts))
    once = len(merged)
    assert list(encoder.stream(texts)) == first and len(merged) == once >= 300_000
    assert first[::90] == encoder.whole(texts[::90])
