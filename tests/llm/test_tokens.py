"""The range coder and the token files: exact round trips, damage, and the ids of whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import rangecoder, tokens
from basketry.llm._text import flat
from basketry.session import new_table_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string"


def round_trip(blocks, bits=16):
    coded = rangecoder.encode_blocks(blocks, bits)
    back = rangecoder.decode_blocks(coded, [len(b) for b in blocks], bits)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back, strict=True))
    return coded


@settings(deadline=None, max_examples=40)
@given(st.lists(st.lists(st.integers(0, 65535), max_size=60), max_size=6))
def test_any_ids(blocks):
    round_trip([np.array(b, np.uint32) for b in blocks])


def test_extremes():
    random = np.random.default_rng(1)
    blocks = [
        np.zeros(5000, np.uint32),
        np.full(300, 65535, np.uint32),
        random.integers(0, 65536, 4000).astype(np.uint32),
        np.tile(np.arange(7, dtype=np.uint32), 500),
        np.zeros(0, np.uint32),
    ]
    coded = round_trip(blocks)
    assert len(coded[0]) < 100 and len(coded[3]) < 400
    round_trip([random.integers(0, 1 << 20, 200).astype(np.uint32)], 20)
    with pytest.raises(ValueError):
        rangecoder.encode_blocks([np.array([70000])], 16)


def test_blocks_are_coded_on_their_own():
    random = np.random.default_rng(2)
    blocks = [random.integers(0, 300, n).astype(np.uint32) for n in (100, 900, 5)]
    assert rangecoder.encode_blocks(blocks) == [rangecoder.encode_blocks([b])[0] for b in blocks]


def test_contexts_help():
    """Text-like ids, where the next follows from the last two, take fewer bits than a static code."""
    random = np.random.default_rng(3)
    words = [random.integers(0, 50000, 4) for _ in range(40)]
    ids = np.concatenate([words[i] for i in random.integers(0, 40, 1500)]).astype(np.uint32)
    assert len(rangecoder.encode_blocks([ids])[0]) * 8 / len(ids) < 4


@settings(deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_sums_of_parts(parts):
    assert tokens.crc_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


TRICKY = [
    "", " ", "  two  spaces ", "a\n\n b\t", "don't, I'll 'sam's", "x  y  z  w", "é　 è", "1,234.5!!",
    "<|endoftext|> in <|endoftext|>", "a<|endoftext|>b", "word, word; (word) [word]", "\r\n\r\n end\n", "ünïcode — ok", "\x85 a",
]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(alphabet="ab'sé ,.!\n\t  1<|>", max_size=20), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(more):
    texts = TRICKY + more
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    ids, counts = tokens._encoder(PATH).encode(*flat(pa.array(texts)))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [e.ids for e in whole]


def expected(rows):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        yield doc_id, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def test_files(spark, monkeypatch):
    long = " ".join(f"token{i * i % 997}" for i in range(6000))
    rows = [(5, "five"), (-3, None), (9, long), (7, ""), (5, "five"), (None, "no id"), (6, long)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    folder = new_table_path(spark)
    got = sorted((tuple(r) for r in tokens.tokenize(df, PATH, folder).collect()), key=lambda r: r[1])
    assert got == list(expected(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))))
    assert tokens.tokenize(df.limit(0), PATH).count() == 0

    payloads = [bytes(r["payload"]) for r in spark.read.parquet(folder).collect()]
    assert sum(len(ids) for _, _, ids in tokens.read_blocks(payloads)) == sum(r[2] for r in got)
    for at in (len(payloads[0]) - 1, 12):
        damaged = bytearray(payloads[0])
        damaged[at] ^= 64
        with pytest.raises(ValueError):
            list(tokens.read_blocks([bytes(damaged)]))


def test_damage_anywhere_in_a_header_is_found_before_decoding(monkeypatch):
    pieces = np.array([(7, 300, tokens.BEGINS | tokens.ENDS), (8, 50, tokens.BEGINS)], tokens._PIECE)
    ids = np.random.default_rng(4).integers(0, 50000, 350).astype(np.uint32)
    payload = tokens._payloads([(0, pieces, ids)], 16)[0]
    (first, cut, back), = tokens.read_blocks([payload])
    assert first == 0 and (cut == pieces).all() and (back == ids).all()
    monkeypatch.setattr(rangecoder, "decode_blocks", lambda *a: pytest.fail("decoded a damaged block"))
    size = tokens._HEAD.itemsize + pieces.nbytes
    for at in range(len(payload)):
        for flip in (1, 64, 255) if at < size else (8,):
            damaged = bytearray(payload)
            damaged[at] ^= flip
            with pytest.raises(ValueError):
                list(tokens.read_blocks([bytes(damaged)]))
    for n in (0, 3, tokens._HEAD.itemsize - 1, size - 1, len(payload) - 1):
        with pytest.raises(ValueError):
            list(tokens.read_blocks([payload[:n]]))


def test_headers_that_disagree_with_their_pieces_are_refused():
    ids = np.arange(40, dtype=np.uint32)
    pieces = np.array([(7, 39, tokens.BEGINS)], tokens._PIECE)
    with pytest.raises(ValueError, match="bounds"):
        list(tokens.read_blocks(tokens._payloads([(0, pieces, ids)], 16)))
    long = np.zeros(rangecoder.BLOCK + 1, np.uint32)
    pieces = np.array([(7, len(long), tokens.BEGINS)], tokens._PIECE)
    with pytest.raises(ValueError, match="bounds"):
        list(tokens.read_blocks(tokens._payloads([(0, pieces, long)], 16)))


def test_a_few_blocks_join_the_last_group():
    """A step costs nearly as much for a hundred lanes as for a thousand."""
    lanes = rangecoder.LANES
    assert list(tokens._groups(0)) == [] and list(tokens._groups(lanes + 102)) == [(0, lanes + 102)]
    for n in (1, lanes, 2 * lanes + 1, 3 * lanes - 1, 9 * lanes + lanes // 2):
        groups = list(tokens._groups(n))
        assert [lo for lo, _ in groups] == [0, *(hi for _, hi in groups[:-1])] and groups[-1][1] == n
        assert all(hi - lo <= lanes * 5 // 4 for lo, hi in groups) and all(hi - lo >= lanes for lo, hi in groups[:-1])


def test_digits_found_by_counting():
    """The reader's digit is the last whose place begins at or below the value, for places of any width."""
    pick = np.random.default_rng(4)
    starts = np.sort(pick.integers(0, 1 << 15, (300, 16)), axis=1).astype(np.int16)
    starts[:, 0] = 0
    reader = rangecoder._Reader([pick.bytes(64) for _ in range(300)])
    part = reader.range >> np.uint64(15)
    value = np.minimum(reader.code // part, np.uint64((1 << 15) - 1)).astype(np.int64)
    found = reader.digit(np.arange(300), starts, None)
    assert found.tolist() == [int(np.searchsorted(row, v, "right")) - 1 for row, v in zip(starts.astype(np.int64), value)]
    assert reader.words.dtype == np.uint16


def test_a_task_holds_ids_once_and_forgets_pieces():
    encoder = tokens.Encoder(PATH)
    batch = pa.RecordBatch.from_pydict({"doc_id": [4, None, 6], "text": ["some words here", "words, again", None]})
    got = list(tokens._encoded(encoder, iter([batch])))
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t or "" for t in batch["text"].to_pylist()]
    assert [(n, ids.tolist()) for n, ids in got] == [
        (n, tokenizer.encode(t, add_special_tokens=False).ids) for n, t in zip(batch["doc_id"].to_pylist(), texts, strict=True)
    ]
    assert not encoder._known and not len(encoder._ids)
    cut = tokens._Blocks(16, tokens.END_ID)
    for name, ids in got:
        cut.add(name, ids)
    cut.close()
    group = list(cut.full)
    payloads = tokens._payloads(group, 16)
    assert not group
    (back,) = rangecoder.decode_blocks([rangecoder.encode_blocks([cut.full[0][2]])[0]], [len(cut.full[0][2])])
    assert back.base is not None and back.dtype == np.uint32 and (back == cut.full[0][2]).all()
    assert [ids.tolist() for _, _, ids in tokens.read_blocks(payloads)] == [cut.full[0][2].tolist()]


def test_an_id_takes_two_steps_of_the_coder_at_most(monkeypatch):
    calls, span = [0], rangecoder._Writer.span

    def counted(*args):
        calls[0] += 1
        return span(*args)

    monkeypatch.setattr(rangecoder._Writer, "span", counted)
    ids = np.random.default_rng(5).integers(0, 40000, (20, 300)).astype(np.uint32)
    coded = rangecoder.encode_blocks(list(ids))
    assert 300 <= calls[0] <= 600
    assert (np.array(rangecoder.decode_blocks(coded, [300] * 20)) == ids).all()


def test_ids_without_context_cost_little_more_than_their_entropy():
    random = np.random.default_rng(6)
    chance = 1 / np.arange(1, 2001)
    names = random.choice(50000, 2000, replace=False)
    ids = names[random.choice(2000, rangecoder.BLOCK, p=chance / chance.sum())].astype(np.uint32)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    entropy = -(share * np.log2(share)).sum()
    assert len(round_trip([ids])[0]) * 8 / len(ids) < entropy + 1.9


def test_alphabets_of_any_size_in_one_group():
    random = np.random.default_rng(7)
    blocks = [random.permutation(1 << 16)[:n].astype(np.uint32) for n in (1, 15, 16, 17, 255, 256, 257, 4095, 4097, rangecoder.BLOCK)]
    blocks += [np.zeros(0, np.uint32), np.full(9, 65535, np.uint32), np.repeat(blocks[4], 3)]
    assert round_trip(blocks) == [rangecoder.encode_blocks([b])[0] for b in blocks]
    round_trip([random.permutation(1 << 20)[:5000].astype(np.uint32), np.arange(30, dtype=np.uint32)], 20)


def test_many_pieces_go_to_the_tokenizer_as_one_text(monkeypatch):
    texts = [" ".join(f"w{i}ord{i * j % 83}," for i in range(40)) for j in range(30)] + TRICKY
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    encoder, given = tokens.Encoder(PATH), []

    class Counting:
        def encode_batch_fast(self, some, **options):
            given.extend(some)
            return tokenizer.encode_batch_fast(some, **options)

    tokenizer = encoder.tokenizer
    encoder.tokenizer = Counting()
    ids, counts = encoder.encode(*flat(pa.array(texts)))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == whole
    assert len(encoder._known) > 1000 and len(given) < len(encoder._known) / 20
    ids, counts = encoder.encode(*flat(pa.array(texts[::-1])))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == whole[::-1]
    encoder.forget()
    encoder.parting = None
    ids, counts = encoder.encode(*flat(pa.array(texts)))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == whole
