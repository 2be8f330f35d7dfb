"""Encoding, files and counts against the libraries themselves."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from corpus import clashing, documents, found, nothing, prose, rows
from pyarrow import fs
from tokenizers import Tokenizer

from tillroll.llm import bpe, packing, pretokens, token_counts, token_files
from tillroll.llm.pretokens import SAFE, PreTokens

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES, LOWER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, LOWER])
def test_texts_encode_together_as_one_by_one(path, monkeypatch):
    texts = [t or "" for _, t, *_ in rows()] + [prose(i, 5 + i) for i in range(60)]
    texts += ["", " ", "a", " a", "a ", "\n", "a\nb", "\na\n", "a b\nc d.", "x  y", "a\tb", "é à, b.", "a. b! c? d: e; f,", "don't we'll 12 a1"]
    coder = pretokens.PreTokens(path)
    want = [library_ids(path, t) for t in texts]
    assert [ids.tolist() for ids in coder.encode_all(texts)] == want
    monkeypatch.setattr(pretokens, "TOGETHER", 700)
    monkeypatch.setattr(pretokens, "CACHE", 20)
    assert [ids.tolist() for ids in pretokens.PreTokens(path).encode_all(texts)] == want
    assert coder.encode_all([]) == []


@pytest.mark.parametrize("path", [BYTES, LOWER])
def test_words_encode_as_the_library_does(path):
    coder, library = PreTokens(path), Tokenizer.from_file(path)
    assert coder.known
    for _, text, _, _ in rows():
        assert coder.encode(text or "").tolist() == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, LOWER])
def test_every_safe_character_encodes_as_in_the_library(path):
    coder, library = PreTokens(path), Tokenizer.from_file(path)
    every = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000 and regex.match(f"[{SAFE}]", chr(c))]
    for at in range(0, len(every), 200):
        text = " ".join(f"a{c}B{c}{c} {c}1" for c in every[at : at + 200])
        assert coder.plain(text)
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def whole_text_ids(text):
    """Ids of each match of the pattern, merged by itself."""
    coder = bpe.rank_file(RANKS, public_tokenizers.PATTERN).encoding
    ids = []
    for piece in regex.findall(public_tokenizers.PATTERN, text):
        ids += coder._encode_single_piece(piece)
    return ids


def test_round_trip(spark):
    want = []
    for doc_id, text, _, _ in rows():
        ids = whole_text_ids(text or "")
        raw = (text or "").encode()
        want.append(
            (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
        )
    docs = clashing(documents(spark))
    assert found(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)) == sorted(
        want, key=lambda r: [(x is not None, x) for x in r]
    )
    assert bpe.round_trip(nothing(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_cut_where_no_match_crosses():
    coder = bpe.RankFile(RANKS, public_tokenizers.PATTERN)
    text = prose(7, 60_000)
    chunks = list(coder.chunks(text))
    assert len(chunks) > 2 and "".join(chunks) == text
    assert coder.encode(text) == coder.encoding.encode_ordinary(text)
    spaces = "end" + " " * 2_000_000 + "start\n"
    assert coder.decode(coder.encode(spaces)) == spaces.encode()


def test_encode_and_decode_frames(spark):
    encoded = bpe.encode(documents(spark), RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert Counter((r["doc_id"], bytes(r["bytes"])) for r in decoded.collect()) == Counter(
        (i, (t or "").encode()) for i, t, _, _ in rows()
    )


def test_cut_ids_decode_to_raw_bytes():
    coder = bpe.rank_file(RANKS, public_tokenizers.PATTERN)
    ids = coder.encode("日本語 テスト 한국")
    assert b"".join(coder.decode([i]) for i in ids) == "日本語 テスト 한국".encode()


def test_token_counts(spark):
    want = []
    for doc_id, text, _, _ in rows():
        n = len(library_ids(LOWER, text))
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    got = found(token_counts.count_tokens(clashing(documents(spark)), LOWER, 2048))
    assert got == sorted(want, key=lambda r: [(x is not None, x) for x in r])
    assert token_counts.count_tokens(nothing(spark), LOWER, 2048).count() == 0


def test_token_counts_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK_PIECES", 50)
    data = [(i, prose(i, 40 + i), "en", "s") for i in range(60)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(documents(spark, data), LOWER, 9).collect()}
    assert got == {i: len(library_ids(LOWER, t)) for i, t, _, _ in data}


def test_token_files(spark):
    data = rows()
    order = sorted(range(len(data)), key=lambda k: (data[k][0] is not None, data[k][0] or 0, data[k][1] or ""))
    want, at = [], 0
    for k in order:
        ids = [*library_ids(LOWER, data[k][1]), 2]
        want.append((data[k][0], at, len(ids), crc(ids)))
        at += len(ids)
    files = token_files.write(clashing(documents(spark)), LOWER, end=2)
    assert sorted(found(token_files.read(files)), key=lambda r: r[1]) == want
    assert token_files.read(token_files.write(nothing(spark), LOWER, end=2)).count() == 0


def test_any_token_of_a_file(tmp_path):
    rng = np.random.default_rng(3)
    lists = [rng.choice([3, 200, 300, 40_000, 70_000, 20_000_000], n).astype(np.uint32) for n in (0, 1, 700, 2000)]
    (tmp_path / "x").write_bytes(token_files.to_bytes([4, None, -1, 9], lists))
    whole = np.concatenate(lists)
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as source:
        file = token_files.TokenFile(source)
        assert (file.docs, file.ids, file.levels) == (4, len(whole), 4)
        assert file.doc_ids() == [4, None, -1, 9]
        assert file.starts() == [0, 0, 1, 701, 2701]
        assert [file.get(i) for i in range(0, len(whole), 7)] == whole[::7].tolist()
        for a, b in ((0, 2701), (5, 6), (510, 1030), (700, 700), (2690, 2701)):
            assert file.slice(a, b).tolist() == whole[a:b].tolist()
        with pytest.raises(IndexError):
            file.get(len(whole))


def checked_pieces(pieces, data, end=0):
    """Every id in one piece, every sequence full but the last."""
    lists = {}
    for doc_id, text, _, _ in data:
        lists.setdefault(doc_id, []).append([*library_ids(BYTES, text), end])
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == set(lists)
    for doc_id, own in by_doc.items():
        copies = lists[doc_id]
        assert sorted(p["doc_tokens"] for p in own if p["start"] == 0) == sorted(map(len, copies))
        assert sum(p["length"] for p in own) == sum(map(len, copies))
        for p in own:
            assert any(
                p["doc_tokens"] == len(c) and p["ids_crc32"] == crc(c[p["start"] : p["start"] + p["length"]])
                for c in copies
            )
    for number, spans in by_sequence.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 1024 or number == max(by_sequence)
    assert set(by_sequence) == set(range(len(by_sequence)))


def test_packing(spark):
    checked_pieces(packing.pack(clashing(documents(spark)), BYTES, end=0).collect(), rows())
    assert packing.pack(nothing(spark), BYTES, end=0).count() == 0


def test_packing_holds_the_mixture_in_every_window(spark):
    data = [(i, prose(i, 300), "en", "abc"[min(2, i % 6)]) for i in range(120)]
    pieces = packing.pack(documents(spark, data), BYTES, end=0, window_sequences=4).collect()
    checked_pieces(pieces, data)
    queues, windows = Counter(), Counter()
    for p in pieces:
        queues[p["queue"]] += p["length"]
        windows[p["queue"], p["sequence_id"] // 4] += p["length"]
    total = sum(queues.values())
    for w in range(total // 4096):
        for q, n in queues.items():
            assert abs(windows[q, w] - 4096 * n / total) < 2


def test_packing_by_weights(spark):
    data = [(i, prose(i, 300), "en", "ab"[i % 2]) for i in range(60)]
    pieces = packing.pack(documents(spark, data), BYTES, 0, window_sequences=2, weights={"a": 3, "b": 1}).collect()
    checked_pieces(pieces, data)
    first = Counter()
    for p in pieces:
        if p["sequence_id"] < 8:
            first[p["queue"]] += p["length"]
    assert abs(min(first.values()) - 2048) <= 1 and sum(first.values()) == 8192


def test_schedule_is_whole_for_any_weights():
    import random

    rng = random.Random(5)
    for _ in range(100):
        totals = [rng.randint(1, 900) for _ in range(rng.randint(1, 5))]
        weights = rng.choice([None, [rng.choice([0.0, 0.1, 1, 3]) for _ in totals]])
        schedule = packing.Schedule(packing.phases(totals, 32, weights), 32)
        places = []
        for q, t in enumerate(totals):
            at = 0
            while at < t:
                n = min(t - at, rng.randint(1, 40))
                places += [s * 8 + o + j for _, s, o, k in schedule.pieces(q, at, n, 8) for j in range(k)]
                at += n
        assert sorted(places) == list(range(sum(totals)))


def test_small_sources_share_a_queue(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 3)
    data = [(i, prose(i, 50), "en", f"s{i % 9}") for i in range(90)]
    pieces = packing.pack(documents(spark, data), BYTES, end=0).collect()
    checked_pieces(pieces, data)
    assert {p["queue"] for p in pieces} == {0, 1, 2}


def given_first(pieces, sequences):
    """Tokens of each queue in the first sequences."""
    first = Counter()
    for p in pieces:
        if p["sequence_id"] < sequences:
            first[p["queue"]] += p["length"]
    return first


@pytest.mark.parametrize("tiny", [None, "c"])
def test_a_tiny_source_takes_no_weight_away(spark, tiny):
    data = [(i, prose(i, 300), "en", "aabab"[i % 5]) for i in range(60)] + [(60, "", "en", tiny)]
    weights = {"a": 0.5, "b": 0.5}
    pieces = packing.pack(documents(spark, data), BYTES, 0, window_sequences=2, weights=weights).collect()
    checked_pieces(pieces, data)
    assert sorted(given_first(pieces, 8).values()) == [4096, 4096]
    # The tiny source has no weight: it comes after all others.
    assert [p["sequence_id"] for p in pieces if p["doc_id"] == 60] == [max(p["sequence_id"] for p in pieces)]


def test_small_sources_keep_their_weights(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 3)
    # The sources with weights are smaller than all others, and more than MOST_QUEUES.
    data = [(i, prose(i, 260 if i % 9 < 5 else 300), "en", f"s{i % 9}") for i in range(180)]
    weights = {f"s{i}": 1 for i in range(5)}
    pieces = packing.pack(documents(spark, data), BYTES, 0, window_sequences=2, weights=weights).collect()
    assert {p["doc_id"] for p in pieces} == {row[0] for row in data}
    first = given_first(pieces, 10)
    assert len(first) == 5 and all(abs(n - 2048) <= 1 for n in first.values())


def test_over_256_sources_with_weights(spark):
    data = [(i, prose(i, 12), "en", f"s{i % 300}") for i in range(900)]
    weights = {f"s{i}": 1 + (i == 299) for i in range(300)}
    pieces = packing.pack(documents(spark, data), BYTES, 0, window_sequences=2, weights=weights).collect()
    assert {p["doc_id"] for p in pieces} == {row[0] for row in data}
    first = given_first(pieces, 2)
    queue = {p["doc_id"] % 300: p["queue"] for p in pieces}
    assert len(set(queue.values())) == 300
    assert abs(first[queue[299]] - 2 * 2048 / 301) <= 1
    assert all(abs(first[queue[i]] - 2048 / 301) <= 1 for i in range(299))
