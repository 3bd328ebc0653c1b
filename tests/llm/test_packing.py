import random
import zlib
from collections import defaultdict

import awkward
import numpy as np
from tokenizers import Tokenizer

from tillroll.llm import packing
from tillroll.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")
ODD = ["It's 2024 <|endoftext|> X", "ÀÉ é ﬁ İ Σς", "   \x1c á", "日本語 🙂"]
EXTRA = [(500 + k, t, "en", None if k else "zz", len(t)) for k, t in enumerate(ODD)]


def check_round_trip(df, pieces):
    model = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        want[r.doc_id].append(tuple(model.encode(r.text or "", add_special_tokens=False).ids) + (1,))
    rows = pieces.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, texts in want.items():
        crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
        # every piece fits a copy; together they cover each copy once
        got = sorted((r.start, r.length) for r in by_doc[doc])
        assert sum(n for _, n in got) == sum(map(len, texts))
        assert all(any(crc(t[r.start:r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(t) for t in texts) for r in by_doc[doc])
        if len(texts) == 1:
            at = 0
            for start, n in got:
                assert start == at and n > 0
                at += n
    padding = 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.SIZE
        padding += 0 if at & (at - 1) == 0 else packing.SIZE - at
    assert padding == 0
    return rows


def test_round_trip(spark, sf_small):
    for df in (awkward.docs(spark, EXTRA), spark.read.parquet(f"{sf_small}/documents.parquet")):
        check_round_trip(df, packing.pack(df, PATH))


def test_words_have_the_ids_of_the_library(sf_small):
    import pyarrow.parquet as pq
    model = Tokenizer.from_file(PATH)
    words = {w for t in pq.read_table(f"{sf_small}/documents.parquet")["text"].to_pylist() for w in (t or "").split()}
    words |= {"don't", "DON'T.", "ÀÉß!", "ſtart", "İx", "Ω", "a.b", "...", "x,", ",", "é", "e\u0301", "ﬁn", "Ÿa", "ÿ;", "µm", "ªa",
              "<|endoftext|>", "a1", "z" * 300, "\x01", "a\x01", "\u212A", "\u212Bng", "STRA\u1E9EE.", "İ", "Ǆ", "<|STARTOFTEXT|>"}
    words = sorted(words)
    encoder = packing.WordEncoder(PATH)
    assert encoder.fast is not None
    for _ in range(2):
        coded, first, second = encoder.encode(packing.pa.array(words, packing.pa.large_string()))
        coded = [np.frombuffer(x, np.uint32).tolist() for x in coded] + [[]]
        assert [coded[a] + coded[b] for a, b in zip(first, second)] == [e.ids for e in model.encode_batch(words, add_special_tokens=False)]


def given_by_time(rows, size):
    """Tokens that each source has given by each output position at which a document's stretch ends."""
    order = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    given, out = defaultdict(int), []
    for r in order:
        given[r.source] += r.length
        out.append(dict(given))
    return out


def test_queues_are_ahead_of_their_shares_by_less_than_a_stretch(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("doc_id", "text", "lang as source")
    rows = check_round_trip(df, packing.pack(df, PATH))
    states = given_by_time(rows, packing.SIZE)
    total = states[-1]
    every, k = sum(total.values()), len(total)
    for given in states:  # the deficit carried, of any queue at any time: bounded whatever the output's length
        g = sum(given.values())
        for source, n in total.items():
            assert abs(given.get(source, 0) - g * n / every) <= packing.SIZE * (1 + k * n / every)
    targets = {"en": 1, "de": 1}  # the others only when these two have ended
    rows = check_round_trip(df, packing.pack(df, PATH, targets))
    for given in given_by_time(rows, packing.SIZE):
        if max(given.get(s, 0) for s in total if s not in targets) if set(given) - set(targets) else 0:
            assert all(given[s] == total[s] for s in targets)
        elif all(given.get(s, 0) < total[s] for s in targets):
            assert abs(given.get("en", 0) - given.get("de", 0)) <= packing.SIZE


def test_documents_stay_whole_but_for_window_ends(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = packing.pack(df, PATH).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for own in pieces.values():
        own.sort(key=lambda r: r.start)
        for a in own[:-1]:  # a piece ends with its window, or after ``SIZE`` tokens of its document
            assert a.offset + a.length == packing.SIZE or (a.start + a.length) % packing.SIZE == 0 or a.sequence_id >= max(r.sequence_id for r in rows) - 11
    assert len(rows) < 1.1 * sum(1 + 2 * (own[0].doc_tokens // packing.SIZE) + (own[0].doc_tokens <= packing.SIZE) for own in pieces.values())


def test_pieces_cover_every_position_once():
    rng = random.Random(5)
    for _ in range(200):
        size = 1 << rng.randrange(3, 8)
        lengths = [rng.randrange(1, 4 * size) for _ in range(rng.randrange(1, 9))]
        total, at, seen = sum(lengths), 0, defaultdict(list)
        cuts = packing.tail_cuts(total, size)
        for n in lengths:
            parts = list(packing.cut_at_windows(at, n, total, cuts, size))
            assert sum(p[2] for p in parts) == n
            at += n
            for sequence, offset, length in parts:
                seen[sequence].append((offset, length))
        assert sorted(seen) == list(range(len(seen)))
        for sequence, parts in seen.items():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end and length > 0
                end += length
            assert end == size if sequence < total // size else end & (end - 1) == 0


def test_empty_table(spark):
    assert packing.pack(awkward.empty(spark), PATH).count() == 0


def test_many_small_sources_have_their_shares_and_targets(spark):
    rows = [(k, "word " * (30 + k % 7), f"s{k % 300}" if k % 3 else "large") for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    size = 256
    out = check_round_trip(df, packing.pack(df, PATH))
    total = defaultdict(int)
    for r in out:
        total[r.source] += r.length
    every = sum(total.values())
    for given in given_by_time(packing.pack(df, PATH, size=size).collect(), size)[::7]:
        g = sum(given.values())
        assert abs(given.get("large", 0) - g * total["large"] / every) <= 40 * (1 + len(total) * total["large"] / every)
    small = min(total, key=lambda s: (total[s], s))
    for given in given_by_time(packing.pack(df, PATH, {small: 1, "large": 1}, size).collect(), size):
        if given.get(small, 0) < total[small]:
            assert set(given) <= {small, "large"} and abs(given.get(small, 0) - given.get("large", 0)) <= 40


def test_hot_source_and_long_document_are_interleaved(spark):
    rows = [(0, "long " * 30_000, "a"), *((k, "short text here", "b") for k in range(1, 3001))]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), PATH).collect()
    assert len([r for r in out if r.doc_id == 0]) <= 2 * (1 + 30_001 // packing.SIZE) + 11
    states = given_by_time(out, packing.SIZE)
    total = states[-1]
    for given in states:
        g = sum(given.values())
        assert abs(given.get("a", 0) - g * total["a"] / sum(total.values())) <= 3 * packing.SIZE
