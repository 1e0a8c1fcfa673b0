"""Token counts, ids on disk and byte-level BPE beside the libraries they must equal."""

import gc
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from cropweave.llm import byte_bpe, coded_ids, token_counts

ODD = [
    "", None, "a", "   ", "<|endoftext|> x <|endoftext|><|endoftext|>y", "aaaaaaaaaaaaa" * 300, "ab" * 4000,
    "  \n\n x\x1c\x85 y \t", "éé 漢字 \U0001f600\U0001f468‍\U0001f469", "it's I'LL don't 'sx", "1234 5678.90 !?!? ...",
    "Σσς İstanbul ẞ", "<|startoftext|>Hi<|endoftext|>", "\x00\x01   ﻿", "word " * 30_000, "a", "a",
]
ROWS = [(k, x) for k, x in enumerate(ODD)] + [(3, "   "), (None, "no id"), (3, "other text, same id")]


@pytest.fixture(scope="module")
def sample():
    return pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pydict()


def rows_of(df, *names):
    return sorted([tuple(r[x] for x in names) for r in df.collect()], key=lambda x: tuple((y is None, y) for y in x))


def test_counts_equal_the_library(documents):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = rows_of(token_counts.count_tokens(documents(ROWS), P.path("byte_bpe_50k.json"), P.PATTERN, 5), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for doc, text in ROWS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc, len((text or "").encode()), n, n > 5))
    assert got == sorted(want, key=lambda x: tuple((y is None, y) for y in x))


def test_counts_of_real_and_random_texts(sample):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = sample["text"][:60] + ["".join(rng.choice("aab '\n1.é漢") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    count = token_counts.Counter(P.path("byte_bpe_50k.json"), P.PATTERN)
    assert count(texts).tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words_by_linked_places(monkeypatch):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    letters = lambda some, n: "".join(rng.choice(some) for _ in range(n))
    texts = [letters("abcdefghijklmnopqrstuvwxyz", 5000), letters("aab", 3000), "a" * 4001, letters("漢字文書", 2000), letters("etaoin", 700), "", "x"]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    for rounds in (0, 3, 64, 10_000):
        monkeypatch.setattr(token_counts, "ROUNDS", rounds)
        assert token_counts.Counter(P.path("byte_bpe_50k.json"), P.PATTERN)(texts).tolist() == want, rounds


def test_a_word_of_a_million_letters_ends_soon():
    rng = np.random.default_rng(2)
    count = token_counts.Counter(P.path("byte_bpe_50k.json"), P.PATTERN)
    began = time.process_time()
    assert 300_000 < count([rng.integers(97, 123, 1_000_000).astype(np.uint8).tobytes().decode()])[0] < 1_000_000
    assert time.process_time() - began < 60


def test_pieces_of_every_character_class():
    """The splitting pattern sees every character as the library does."""
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = "".join(f"a{chr(c)}1{chr(c)} " for c in range(0x20000) if not 0xD800 <= c < 0xE000 and c != 0xFFFD)[:400_000]
    count = token_counts.Counter(P.path("byte_bpe_50k.json"), P.PATTERN)
    assert count([text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_transducer_equals_the_library(documents):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = P.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode_documents(documents(ROWS), path, P.PATTERN)
    got = rows_of(byte_bpe.decode_documents(coded, path, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "valid_utf8")
    want = []
    for doc, text in ROWS:
        ids = library.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((doc, len(ids), *sha, True))
    assert got == sorted(want, key=lambda x: tuple((y is None, y) for y in x))
    at_once = rows_of(byte_bpe.round_trip(documents(ROWS), path, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "valid_utf8")
    assert at_once == got


def test_transducer_on_random_bytes_and_small_memory(monkeypatch, sample):
    monkeypatch.setattr(byte_bpe, "STATES", 50)
    monkeypatch.setattr(byte_bpe, "PAIRS", 20)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 30)
    path, rng = P.path("byte_bpe_multi_50k.tiktoken"), random.Random(5)
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = sample["text"][:20] + ["".join(rng.choice("aaabcdeé漢ß😀 ") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    own = byte_bpe.Codec(path, P.PATTERN)
    for text in texts:
        ids = own.encode([text])[0]
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode_bytes(ids) == text.encode() and own.decode(ids) == text


def test_streaming_decoder_waits_for_whole_characters():
    own = {k: bytes([k]) for k in range(256)}
    for data in ("é漢😀a".encode(), b"\xe6\xbc", b"\xff\xe6a", b"\xed\xa0\x80", b"\xc0\x80", b"\xf4\x90\x80\x80", b"\xf0\x9f\x98x\x80"):
        machine = byte_bpe.StreamDecoder(own)
        got = "".join(machine.feed([x]) for x in data) + machine.finish()
        assert got == data.decode(errors="replace")
    machine = byte_bpe.StreamDecoder(own)
    assert [machine.feed([x]) for x in "é".encode()] == ["", "é"]


def test_ids_on_disk_equal_the_library(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(coded_ids, "SEGMENT_IDS", 3000)
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    path = coded_ids.new_file(str(tmp_path))
    coded_ids.write_ids(documents(ROWS), path, P.path("word_bpe_49k.json"), 2)
    got = rows_of(coded_ids.read_ids(spark, path), "start", "doc_id", "n_tokens", "ids_crc32")
    kept = [x for x in ROWS if x[0] is not None]
    ids = {text: [*library.encode(text or "", add_special_tokens=False).ids, 2] for _, text in kept}
    assert [x[1] for x in got] == sorted(x[0] for x in kept)
    start = 0
    for begin, _, n, _ in got:
        assert begin == start
        start += n
    crc = lambda text: zlib.crc32(np.array(ids[text], "<u4").tobytes())
    assert sorted((d, n, c) for _, d, n, c in got) == sorted((d, len(ids[t]), crc(t)) for d, t in kept)


def test_any_id_is_addressable():
    rng = np.random.default_rng(1)
    ids = rng.choice(np.array([0, 1, 255, 256, 65535, 65536, 2**32 - 1, 49407], np.uint32), 5000)
    own = coded_ids.Segment.of(np.arange(3), np.array([0, 10, 10, 5000]), ids)
    back = coded_ids.Segment.from_bytes(own.to_bytes())
    assert (back.ids() == ids).all()
    assert [back.id_at(k) for k in range(5000)] == ids.tolist()
    assert back.places.tolist() == [0, 10, 10, 5000]
    empty = coded_ids.Segment.from_bytes(coded_ids.Segment.of(np.arange(1), np.array([0, 0]), ids[:0]).to_bytes())
    assert len(empty.ids()) == 0


def test_empty_tables(spark, documents, tmp_path):
    none = documents([])
    assert token_counts.count_tokens(none, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    path = P.path("byte_bpe_50k.tiktoken")
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(none, path, P.PATTERN), path, P.PATTERN).count() == 0
    file = coded_ids.new_file(str(tmp_path))
    coded_ids.write_ids(none, file, P.path("word_bpe_49k.json"), 2)
    assert coded_ids.read_ids(spark, file).count() == 0


def test_pieces_of_all_lengths_keep_their_numbers():
    rng = np.random.default_rng(3)
    table, held = coded_ids.PieceTable(bits=4), {}
    for _ in range(20):
        words = [bytes(rng.integers(0, 3, rng.integers(1, 25)).astype(np.uint8)) for _ in range(200)]
        new = sorted(set(words) - set(held))
        for known, group in ((True, [x for x in words if x in held]), (False, new)):
            data = np.frombuffer(b"".join(group), np.uint8)
            lengths = np.array([len(x) for x in group], np.int64)
            keys, hashes = table.keys(data, np.cumsum(lengths) - lengths, lengths)
            assert table.find(keys, hashes).tolist() == [held[x] if known else -1 for x in group]
            if not known:
                numbers = len(held) + np.arange(len(group))
                table.add(keys, hashes, numbers)
                held |= dict(zip(group, numbers.tolist(), strict=True))


def test_words_are_not_cut_by_blocks(monkeypatch):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    texts = ["", "Sun rain,", "x" * 90 + " corn. " + "é漢" * 20, " \t\n", "rain, sun. " * 40, "a", "", "b c"]
    library = Tokenizer.from_file(path)
    raw = [x.encode() for x in texts]
    for block, remembered in ((7, 5), (1 << 21, 800_000)):
        monkeypatch.setattr(coded_ids, "BLOCK_BYTES", block)
        monkeypatch.setattr(coded_ids, "REMEMBERED", remembered)
        own = coded_ids.WordEncoder(path)
        got = own(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [x.tolist() for x in got] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_steps_of_the_decoder_are_taken_once(monkeypatch, sample):
    path = P.path("byte_bpe_50k.tiktoken")
    own, whole = byte_bpe.Codec(path, P.PATTERN), byte_bpe.whole_tokens(path, P.PATTERN)
    texts = ["é漢😀" * 50 + "ọ̀𝔘𐍈", *sample["text"][:20]]
    coded = own.encode(texts)
    assert all(byte_bpe.valid(own, whole, x) for x in coded)
    single = [own.transducer.ranks[bytes([x])] for x in "漢".encode()]
    monkeypatch.setattr(byte_bpe.StreamDecoder, "feed_bytes", None)
    # What has been read before runs no machine again.
    assert all(byte_bpe.valid(own, whole, x) for x in coded)
    monkeypatch.undo()
    a = own.transducer.ranks[b"a"]
    for ids, good in ((single, True), (single[:2], False), ([single[0], a, *single[1:]], False), (single[1:], False), ([a, *single, *single], True), ([*single[:2], *single], False)):
        assert byte_bpe.valid(own, whole, np.array(ids)) is good


def test_states_are_made_without_looking_for_cycles(monkeypatch):
    own, seen = byte_bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), []
    plain = own.transducer.encode
    monkeypatch.setattr(own.transducer, "encode", lambda x: seen.append(gc.isenabled()) or plain(x))
    own.encode(["a few words"])
    assert seen == [False] * 3 and gc.isenabled()
