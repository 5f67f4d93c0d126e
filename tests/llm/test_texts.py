"""Operators on texts against plain versions and the libraries."""

import hashlib
import json
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playstar.llm import byte_bpe, packing, registry, simhash, token_count
from playstar.llm.common import vocabulary
from tests.llm.tables import LONG, TEXTS, documents, smallest_reachable


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    """Documents of the small tables and all awkward ones."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id") + 100, "text").collect()
    return [*TEXTS, *map(tuple, rows)]


def plain_fingerprint(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, given):
    rows = [(i, t) for i, t in given if t is not LONG]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted((str(i), f"{p:016x}") for i, p in prints)
    known = [(i, p) for i, p in prints if i is not None]
    linked = [(a, b) for a, p in known for b, q in known if (p ^ q).bit_count() <= 2]
    component = smallest_reachable({i for i, _ in known}, linked)
    assert all(r.component_id == component.get(r.doc_id) for r in found)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5, 9])
def test_anchors_meet_for_every_linked_pair(distance):
    rng = np.random.default_rng(distance)
    left = rng.integers(-(2**63), 2**63, 300)
    right = left.copy()
    for i in range(len(left)):
        for bit in rng.choice(64, rng.integers(0, distance + 1), replace=False):
            right[i] ^= np.int64(np.uint64(1) << np.uint64(bit))
    a, b = (simhash.anchors(side, distance) for side in (left, right))
    reach = [{(i, s, c) for i, s, c in zip(*side[:3], strict=True)} for side in (a, b)]
    home = {(i, s, c) for i, s, c, near in zip(*a, strict=True) if near}
    assert {i for i, _, _ in home & reach[1]} == set(range(len(left)))


def test_crowded_anchors_are_split_without_loss(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)] + [base]
    monkeypatch.setattr(simhash, "CELL_ROWS", 8)
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs.select("doc_id", F.col("text").cast("long").alias("fingerprint")))
    rows = [(i, str(p)) for i, p in enumerate(prints, 5)]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in found} == {5} and len(found) == len(prints)


def test_chain_of_links_is_one_component(spark):
    from playstar.llm.components import connected_components

    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(500, 400), (None, 3), (7, 7)], "a long, b long"))
    found = {r.node: r.component for r in connected_components(links, "b", "a").collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 500: 400}


def test_packing_is_exact_and_tight(spark, given):
    pieces = packing.pack(documents(spark, given).repartition(2), size=256).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in given)
    assert all(p.length * 4 == len(p.ids) and p.offset + p.length <= 256 for p in pieces)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
    lengths = [sum(p.length for p in parts) for parts in by_sequence.values()]
    assert sum(n < 256 for n in lengths) <= 2  # one for each partition
    assert sum(lengths) == sum(map(len, want))
    single = {i: t for i, t in given if i is not None and sum(j == i for j, _ in given) == 1}
    for i, text in single.items():
        parts = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        ids = np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert {p.doc_tokens for p in parts} == {len(ids)}


@pytest.mark.parametrize("flags", [None, {"lstrip": True}, {"normalized": True}])
def test_added_tokens_inside_a_text(spark, tmp_path, flags):
    path = public_tokenizers.path("word_bpe_49k.json")
    if flags:
        file = json.loads(Path(path).read_text())
        file["added_tokens"][1].update(flags)
        path = str(tmp_path / "flags.json")
        Path(path).write_text(json.dumps(file))
    library = Tokenizer.from_file(path)
    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [f"a {end} b", f"a{end}b", end, f"{start}{end}{end}", f" \n{start}\n x.{end}", f"e{end}\u0301 e\u0301", "<|endoftext", f"a {end.upper()}", f"<|{end}|> it{start}'s"]
    found = packing.pack(documents(spark, list(enumerate(texts))), path, size=64).collect()
    for i, text in enumerate(texts):
        parts = sorted((p for p in found if p.doc_id == i), key=lambda p: p.start)
        want = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == want
        assert {p.doc_tokens for p in parts} == {len(want)}


def test_packer_takes_the_level_with_the_least_sum_of_squares():
    rng = np.random.default_rng(1)
    packer, size = packing.Packer(16, 0), 16
    for _ in range(300):
        n = int(rng.integers(1, 16))
        level = packer.level.copy()

        def squares(h, level=level, n=n):
            after = level.copy()
            if h:
                after[h] -= 1
            if h + n < size:
                after[h + n] += 1
            return int((after**2).sum())

        allowed = [0, *(h for h in range(1, size - n + 1) if level[h])]
        list(packer.place(1, np.zeros(n, "<u4")))
        assert int((packer.level**2).sum()) == min(map(squares, allowed))
        assert [len(w) for w in packer.windows] == packer.level[:size].tolist()


def test_many_open_windows_are_drawn_together(monkeypatch):
    monkeypatch.setattr(packing, "OPEN_WINDOWS", 5)
    packer = packing.Packer(10, 0)
    pieces = [p for i in range(40) for p in packer.place(i, np.arange(6, dtype="<u4"))] + list(packer.draw_together())
    assert sum(p[2] for p in pieces) == 240 and packer.open == 0
    assert all(b"".join(p[3] for p in sorted(pieces, key=lambda p: p[1]) if p[0] == i) == np.arange(6, dtype="<u4").tobytes() for i in range(40))


def test_byte_bpe_equals_the_library_and_comes_back(spark, given):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(documents(spark, given))).collect()
    want = [(str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in given]
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in found) == sorted(want)


def test_long_words_take_the_same_merges(given):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    words = {w for _, t in given for w in (t or "").split()} | {"aaaa" * 30, "abab" * 40 + "é"}
    for word in words:
        value = word.encode()
        if len(value) < 2000:
            whole = ranks.get(value)
            assert byte_bpe.merge_word(value, ranks) == ([whole] if whole is not None else byte_bpe._merge_long(value, ranks))


def test_token_counts_equal_the_library(spark, given, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = token_count.count_tokens(documents(spark, given), limit=50).collect()
    want = [(str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in given]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 50) for r in found)


@pytest.mark.parametrize("chunk", [1, 2, 5, 64])
def test_maps_of_chunks_compose(chunk, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    counter = token_count.worker_counter(path)
    monkeypatch.setattr(token_count, "CHUNK", chunk)
    for _, text in TEXTS:
        text = (text or "")[:700]
        assert counter.of(text) == len(library.encode(text))


def test_states_are_dropped_in_mid_word(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter = token_count.TokenCounter(token_count.read_pieces(path))
    monkeypatch.setattr(token_count, "STATES_KEPT", 20)
    text = "internationalization" * 20 + " of words"
    assert counter.of(text) == len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))


def test_digest_columns(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in registry.op4_byte_bpe(spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in registry.op2_packing(spark, sf_dir).collect():
        ids = [*words.encode(texts[r.doc_id], add_special_tokens=False).ids, 2][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("operator", [simhash.near_duplicates, packing.pack, byte_bpe.encode, token_count.count_tokens])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def test_long_words_are_not_remembered():
    words = packing.WordIds(vocabulary("word_bpe_49k.json"))
    encoder = byte_bpe.worker_encoder(vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefgh,.漢", k=4000)) for _ in range(3)) for _ in range(60)]
    for memory, encode in ((words, words.of), (words.simple, words.of), (encoder, encoder.of)):
        for text in texts:
            encode(text)
        assert max(map(len, memory), default=0) <= 64


def test_latin_words_are_the_librarys_and_share_their_letters(monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    near = [chr(i) for i in range(1, 0x250) if chr(i) not in " \n"]
    draw = random.Random(7)
    found = ["".join(draw.choices(near, k=draw.randint(1, 6))) + draw.choice(["", ".", "'", "'.", "***", "_", "''s"]) for _ in range(4000)]
    words = packing.WordIds(path)
    for word in [*near, *(f"x{c}Y" for c in near), *found]:
        assert np.frombuffer(words.of(word), "<u4").tolist() == library.encode(word, add_special_tokens=False).ids, word

    def refused(*_):
        raise AssertionError("Latin letters and signs after them need neither the library's normalizer nor its pattern")

    words = packing.WordIds(path)
    monkeypatch.setattr(words, "normalize", refused)
    monkeypatch.setattr(words, "pre_tokenize", refused)
    given = "Œuvre œuvre. ŒUVRE*** œuvre'' tionra%%%"
    assert np.frombuffer(words.of(given), "<u4").tolist() == library.encode(given, add_special_tokens=False).ids
    assert {"œuvre", "tionra"} <= set(words) and set(words.simple) == {".", "***", "''", "%%%"}


def test_small_tables_are_written_in_few_files(spark, monkeypatch):
    """However many partitions a shuffle has: fingerprints' classes, links and the toxic sample are small."""
    from playstar.llm import components, toxicity
    from playstar.session import file_names, store

    files = {}

    def stored(df, path, packed=False):
        out = store(df, path, packed)
        label = path.rpartition("/")[2].rpartition("-")[0]
        files.setdefault(label, []).append(sum(name.endswith(".parquet") for name in file_names(spark, path)))
        return out

    for module in (simhash, components, toxicity):
        monkeypatch.setattr(module, "store", stored)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    rows = [(i, f"text {i // 2} has words number {i // 2 * 7} and {i // 2 * 13} of its own") for i in range(400)]
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        docs = documents(spark, rows)
        found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
        toxicity.train(docs, spark.createDataFrame([(i, i % 5 == 0) for i, _ in rows], "doc_id long, toxic boolean"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    prints = {i: r.fingerprint for i, r in found.items()}
    linked = [(a, b) for a in prints for b in range(a) if (int(prints[a], 16) ^ int(prints[b], 16)).bit_count() <= 2]
    assert {i: r.component_id for i, r in found.items()} == smallest_reachable(prints, linked)
    assert set(files["classes"]) == set(files["links"]) == set(files["labelled"]) == {1} and max(files["bags"]) <= toxicity.SAMPLE_FILES
