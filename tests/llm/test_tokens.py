"""Token counts, packing and token files against the tokenizer libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stockmart.llm import packing, token_counts, token_files, token_ids
from stockmart.llm.common import new_folder

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    None, "", " ", "   ", "  a  b ", "a▁b", "▁▁", "日本語 text", "x" * 9000, " " * 9000, "a\n\n b\t c",
    "<s> <unk> <|startoftext|>Hi<|ENDOFTEXT|>", "🙂🙂 x", "İstanbul é ́a", "a  b c", "\x00\x01",
    "foo...,", "a., b.. c,", "Kelvin K", "don't 've x's,", "12.5, 3.", "é, è.", "word " * 5000,
]


def texts(n=300):
    rng = random.Random(3)
    made = ["".join(rng.choice("abc ▁\n.,'s't<|é12日") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return ODD + made + ["".join(rng.choice("abcdefghij日é") for _ in range(20_000))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 4 else i // 2 if i < 4 else i, t, i) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5).cache()


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path(token_ids.VOCABULARY)).encode
    return lambda text, end: [*encode(text or "", add_special_tokens=False).ids, end]


def test_counts_equal_the_library(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.VOCABULARY))
    got = sorted(map(tuple, token_counts.token_counts(docs).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect()]
    assert got == sorted(want, key=str)


def test_chunks_compose_in_any_order():
    counts = token_counts.counter().transducer
    text = "▁" + "".join(random.Random(5).choice("abcdefghij\n") for _ in range(3000))
    whole = counts.count(text)
    for size in (1, 2, 7, 100, 5000):
        assert counts.count(text, chunk=size) == whole
        maps = [counts.state_map(text[i : i + size]) for i in range(0, len(text), size)]
        prefixes = counts.scan(maps)
        assert len(prefixes) == len(maps)
        middle = prefixes[len(maps) // 2]
        part = text[: (len(maps) // 2 + 1) * size]
        assert counts.run(0, middle.head)[1] + middle.count == counts.run(0, part)[1]


def test_forgotten_states_and_words_change_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 20)
    path = public_tokenizers.path(token_counts.VOCABULARY)
    small, large = token_counts.Counter(path), token_counts.counter()
    small.cache.limit = 5
    array = pa.array([t or "" for t in texts(50)], pa.large_string())
    assert small.of(array).tolist() == large.of(array).tolist()


def pieces_are_whole(rows, want, length):
    """Every id of every document once, sequences gapless; returns lengths by sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[doc])
            piece = np.array(want[doc][at : at + p.length], "<u4").tobytes()
            assert zlib.crc32(piece) == p.ids_crc32
            at += p.length
        assert at == len(want[doc])
    assert set(by_doc) == set(want)
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        sizes.append(at)
    return sizes


@pytest.mark.parametrize("length,most_open,fan_in", [(2048, 32, 64), (64, 3, 2)])
def test_packing_is_whole(spark, ids, length, most_open, fan_in):
    rows = list(enumerate(texts(60)))
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string").repartition(7)
    got = packing.pack(frame, length=length, most_open=most_open, fan_in=fan_in).collect()
    sizes = pieces_are_whole(got, {i: ids(t, 1) for i, t in rows}, length)
    padding = sum(length - s for s in sizes if s & (s - 1))
    assert padding == 0
    assert sum(s < length for s in sizes) <= length.bit_length()


def test_packing_takes_repeated_ids_and_no_rows(spark, docs, ids):
    got = packing.pack(docs)
    assert got.groupBy().sum("length").first()[0] == sum(len(ids(r.text, 1)) for r in docs.collect())
    assert packing.pack(docs.where("false")).count() == 0


def test_best_fit_takes_the_least_room():
    packer = packing.Packer(0, length=16, most_open=2)
    for doc, n in enumerate((10, 12, 4, 5)):
        packer.add(doc, 0, np.arange(n, dtype=np.uint32), n)
    # 4 fits both windows and goes where 4 are left; 5 goes to the other.
    assert [(p[0], p[5], p[6]) for p in packer.out] == [(1, 1, 0), (2, 1, 12)]
    packer.add(4, 0, np.arange(9, dtype=np.uint32), 9)
    packer.add(5, 0, np.arange(12, dtype=np.uint32), 12)
    # Nothing takes 12: the fullest (1 left) is topped up and emitted without padding.
    assert [(p[0], p[1], p[2]) for p in packer.out if p[5] == 0] == [(0, 0, 10), (3, 0, 5), (5, 0, 1)]
    assert len(packer.rooms) <= 2


def test_token_files_round_trip(spark, docs, ids):
    path = new_folder(spark, "tokens")
    token_files.write_tokens(docs, path)
    got = sorted(token_files.verify_tokens(spark, path).collect(), key=lambda r: r.start)
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode())
    start, want = 0, []
    for r in sorted(docs.collect(), key=key):
        encoded = ids(r.text, 2)
        want.append((r.doc_id, start, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes())))
        start += len(encoded)
    assert list(map(tuple, got)) == want
    some = token_files.read_tokens(spark, path).where("doc_id = 40").select("n_tokens")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,40)]" in some._jdf.queryExecution().toString()
    assert some.count() == 1


def test_token_files_hold_page_indexes_and_dictionaries(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "tokens"
    token_files.write_tokens(docs, str(path))
    file = max(path.glob("*.parquet"), key=lambda p: p.stat().st_size)
    columns = pq.ParquetFile(file).metadata.row_group(0)
    for i in range(columns.num_columns):
        column = columns.column(i)
        assert column.has_offset_index and column.has_column_index
        if column.path_in_schema.startswith("ids"):
            assert "RLE_DICTIONARY" in column.encodings


def test_token_files_of_no_rows(spark, docs):
    path = new_folder(spark, "tokens")
    token_files.write_tokens(docs.where("false"), path)
    assert token_files.verify_tokens(spark, path).count() == 0
