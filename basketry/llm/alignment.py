"""Alignment of two tokenizers over a corpus, by products of token-byte incidence matrices (:mod:`csr`).

Tokenizer A is byte-level BPE (tokenizers library) and reads a space and the text, B is a sentencepiece model with byte fallback and reads
the text, before which it puts that space. Both sequences of tokens then cover the same bytes, or the text has no tokens.

*Matrices.* A tokenizer's incidence matrix has a row for each token and a one for each byte it covers. The row products A·Bᵀ are
the overlap links: which tokens share bytes, and how many. Links whose tokens end together cut the bytes into groups; the
incidence matrices of tokens and groups give, by the same product, the links of tokens in one group.

*Words.* Neither tokenizer joins tokens across a single space or line feed between other characters (the constructor checks B's
pieces; A's pre-tokenizer cuts there), so texts are aligned word by word and a worker aligns each different word once, many
in one matrix. Where white space is of another kind the words around it are aligned as one.

*Corpus counts.* How often two ids are linked in all documents needs every document. Linked tokens end at the same byte, so the bytes of
one are the end of the other's: at most as many pairs can be linked as the tokens of both vocabularies have ends,
whatever the corpus (:meth:`Aligner.most_pairs`). The table of counts has that proven bound and goes to the tasks whole.

Null and empty texts, and texts that a tokenizer does not give back byte by byte, have zeros and an empty digest. Repeated rows are documents
of their own. Only ``doc_id`` and ``text`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import csr
from basketry.llm._text import ragged
from basketry.session import materialize

#: words that a worker remembers, and their characters, before it starts anew
REMEMBERED = 300_000
REMEMBERED_CHARS = 16 << 20
#: characters of texts whose new words are learnt together, and of new words aligned in one matrix
GROUP = 1 << 20
MATRIX_CHARS = 1 << 17
#: characters of new words that a tokenizer reads at once
RUN = 1 << 14
#: entries of one batch of results
FLUSH = 1 << 20
_WORD = re.compile(r"\s*\S+|\s+")
_CUT = re.compile(r"(?<=\S)[ \n](?=\S)")
#: characters of a text that are cut into words at once
PIECE = 1 << 20
_SPACE = "▁"


@dataclass(frozen=True)
class Links:
    """Aligned words: for each, where its tokens begin in ``a`` and ``b``, ids, and the links among them."""

    a: np.ndarray
    b: np.ndarray
    overlap: csr.Csr
    together: np.ndarray  # overlap entries whose tokens end together
    group_a: np.ndarray
    group_b: np.ndarray
    shared: csr.Csr


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Links:
    """``size_a[i]`` bytes of token ``a[i]``, and so for ``b``; both cover the same bytes."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    width = int(end_a[-1]) if len(end_a) else 0
    bytes_b = csr.transpose(csr.intervals(end_b - size_b, end_b, width))
    overlap = csr.multiply(csr.intervals(end_a - size_a, end_a, width), bytes_b)
    rows = overlap.rows()
    together = np.flatnonzero(end_a[rows] == end_b[overlap.columns])
    cuts = end_a[rows[together]]
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    shared = csr.multiply(csr.units(group_a, len(cuts)), csr.transpose(csr.units(group_b, len(cuts))))
    return Links(a, b, overlap, together, group_a, group_b, shared)


@lru_cache(1)
def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Pool:
    """The bytes of all tokens, to be gathered many at a time."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = np.array([len(t) for t in tokens], np.int64)
        self._start = np.cumsum(self.size) - self.size
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self._bytes[ragged(self._start[ids], self.size[ids])]


class _Rows:
    """A table of integers that grows."""

    def __init__(self, width: int) -> None:
        self.rows = np.zeros((1024, width), np.int64)
        self.n = 0

    def extend(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.rows):
            grown = np.zeros((max(2 * len(self.rows), self.n + len(rows)), self.rows.shape[1]), np.int64)
            grown[: self.n] = self.rows[: self.n]
            self.rows = grown
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


def _plain(word: str) -> bool:
    """Whether a word stands behind a single space or line feed, where both tokenizers cut."""
    return word[0] in " \n" and len(word) > 1 and not word[1].isspace()


def _alone(word: str) -> bool:
    """Whether a word may stand in a row with others: no white space but the first, nothing that reads as a space."""
    return _plain(word) and _SPACE not in word and len(word.split()) == 1 and not word[-1].isspace()


def _text(word: str | tuple[str]) -> str:
    return word if isinstance(word, str) else word[0]


class Aligner:
    """Both tokenizers and the words aligned so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, b = _byte_of(), self._b
        names = [self._a.id_to_token(i) or "" for i in range(self._a.get_vocab_size())]
        self.bytes_a = [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self._pool_a, self._pool_b = _Pool(self.bytes_a), _Pool(self.bytes_b)
        self.width = len(pieces)
        #: pieces that could join what stands before a space or line feed with what follows
        self.by_word = not any(re.search(rf"[^{_SPACE}]{_SPACE}|\n", p) for p in pieces)
        # an id as it stands in the text of a group: A's before another or the last, B's before another, a group or a word
        self._shown = [f"{i}{end}" for i in range(len(names)) for end in ",|"]
        self._shown += [f"{i}{end}" for i in range(len(pieces)) for end in ",;\n"]
        self._forget()

    def _forget(self) -> None:
        #: number of each word; a text's odd first word stands here in a tuple, as it may be found inside other texts
        self._known: dict[str | tuple[str], int] = {}
        self._chars = 0
        self._text: list[str] = []
        self._counts = _Rows(5)  # tokens of A and B, groups, links, and whether the bytes agree
        self._first = _Rows(2)  # where the linked pairs begin, and how many
        self._pairs = _Rows(1)

    def most_pairs(self) -> int:
        """How many pairs of ids can be linked at most: the bytes of one are the end of the other's."""
        a, b = set(self.bytes_a), set(self.bytes_b)
        ends = sum(x[i:] in b for x in self.bytes_a for i in range(len(x)))
        return ends + sum(x[i:] in a for x in self.bytes_b for i in range(1, len(x)))

    def _encode_one(self, word: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a word that begins with a space, or with a line feed inside a text; nothing where the bytes differ."""
        a = np.array(self._a.encode(word, add_special_tokens=False).ids, np.int64)
        b = self._b.encode(word if word[0] == "\n" else word[1:])
        b = np.array(b[1:] if word[0] == "\n" else b, np.int64)
        body = word.encode()
        return (a, b) if self._pool_a.joined(a).tobytes() == body == self._pool_b.joined(b).tobytes() else None

    def _encode_run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of plain words in a row, and how many each word has, if both tokenizers cut where the words end."""
        text = " a" + "".join(words)
        body = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum([2, *(len(w) if w.isascii() else len(w.encode()) for w in words)])
        out = []
        encoded = self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self._b.encode(text[1:])
        for ids, pool in zip(encoded, (self._pool_a, self._pool_b)):
            ids = np.array(ids, np.int64)
            cuts = np.cumsum(pool.size[ids])
            at = np.searchsorted(cuts, ends)
            if len(cuts) == 0 or cuts[-1] != len(body) or (cuts[at] != ends).any() or (pool.joined(ids) != body).any():
                return None
            out += [ids[at[0] + 1 :], np.diff(at)]
        return out[0], out[2], out[1], out[3]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of A and of B, how many each word has, and whether the bytes agree (else it has none)."""
        parts, valid = [], np.ones(len(words), bool)
        none, at = np.zeros(0, np.int64), 0
        while at < len(words):
            run, size = [], 0
            while at + len(run) < len(words) and size < RUN and _alone(words[at + len(run)]):
                run.append(words[at + len(run)])
                size += len(run[-1])
            found = self._encode_run(run) if run else None
            if found:
                parts.append(found)
                at += len(run)
                continue
            for word in run or words[at : at + 1]:
                a, b = self._encode_one(word) or (none, none)
                valid[at] = len(a) > 0
                parts.append((a, b, np.array([len(a)]), np.array([len(b)])))
                at += 1
        return *(np.concatenate([p[j] for p in parts]) for j in range(4)), valid

    def pieces(self, text: str) -> Iterator[str]:
        """The space and the text, very long ones cut where both tokenizers cut."""
        whole, lo = f" {text}", 0
        while self.by_word and len(whole) - lo > PIECE:
            cut = _CUT.search(whole, lo + PIECE)
            if not cut:
                break
            yield whole[lo : cut.start()]
            lo = cut.start()
        yield whole[lo:]

    def words(self, piece: str) -> list[str]:
        """The words of a piece with the white space before each."""
        if not self.by_word:
            return [piece]
        out: list[str] = []
        for word in _WORD.findall(piece):
            if not out or _plain(word):
                out.append(word)
            else:
                out[-1] += word
        return out

    def _learn(self, words: dict) -> None:
        """Align words that are not known yet; an odd first word of a text comes as a tuple."""
        new = [w for w in words if w not in self._known]
        at = 0
        while at < len(new):
            part, size = [], 0
            while at < len(new) and (not part or size < MATRIX_CHARS):
                part.append(new[at])
                size += len(_text(new[at]))
                at += 1
            a, b, n_a, n_b, valid = self._encode([_text(w) for w in part])
            found = align(a, b, self._pool_a.size[a], self._pool_b.size[b])
            rows = found.overlap.rows()[found.together]
            pairs = a[rows] * self.width + b[found.overlap.columns[found.together]]
            # a word's last token ends its last group
            ends = np.append(0, np.append(0, found.group_a + 1)[np.cumsum(n_a)])
            groups = np.diff(np.maximum.accumulate(ends))
            first = self._pairs.n + np.cumsum(groups) - groups
            shown = iter(self._groups(found, np.cumsum(n_b)[valid] - 1))
            for word, good in zip(part, valid.tolist()):
                self._known[word] = len(self._text)
                self._text.append(next(shown) if good else "")
                self._chars += len(_text(word))
            self._counts.extend(np.column_stack([n_a, n_b, groups, groups, valid]).astype(np.int64))
            self._first.extend(np.column_stack([first, groups]).astype(np.int64))
            self._pairs.extend(pairs.reshape(-1, 1))

    def _groups(self, found: Links, last: np.ndarray) -> list[str]:
        """The groups of each word as text; ``last``: places of the words' last B tokens."""
        a_ends = np.append(found.group_a[1:] != found.group_a[:-1], True) if len(found.a) else np.zeros(0, bool)
        b_ends = np.append(found.group_b[1:] != found.group_b[:-1], True).astype(np.int64) if len(found.b) else np.zeros(0, np.int64)
        b_ends[last] = 2
        codes = np.concatenate([found.a * 2 + a_ends, 2 * len(self.bytes_a) + found.b * 3 + b_ends])
        order = np.argsort(np.concatenate([found.group_a * 2, found.group_b * 2 + 1]), kind="stable")
        return "".join(map(self._shown.__getitem__, codes[order].tolist())).split("\n")

    def _numbers(self, pieces: list[str]) -> list[list[int]]:
        """Number of each word of each piece, new words of all learnt together."""
        if len(self._known) > REMEMBERED or self._chars > REMEMBERED_CHARS:
            self._forget()
        raw = [_WORD.findall(p) if self.by_word else [p] for p in pieces]
        out = [[*map(self._known.get, words)] for words in raw]
        new = {w: None for words, at in zip(raw, out) if None in at for w, i in zip(words, at) if i is None and _plain(w)}
        self._learn(new)
        out = [[*map(self._known.get, words)] if None in at else at for words, at in zip(raw, out)]
        odd = {j: [w if i or _plain(w) else (w,) for i, w in enumerate(self.words(pieces[j]))] for j, at in enumerate(out) if None in at}
        self._learn({w: None for words in odd.values() for w in words})
        for j, words in odd.items():
            out[j] = [self._known[w] for w in words]
        return out

    def documents(self, texts: list[str]) -> Iterator[tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]]:
        """For each text its tokens, groups and links, the digest of the groups, and the linked pairs with how often each is linked."""
        pieces = [p for t in texts if t for p in self.pieces(t)]
        begins = iter(np.cumsum([0, *(sum(1 for _ in self.pieces(t)) if len(t) > PIECE else 1 for t in texts if t)]).tolist())
        numbers, lo = [], 0
        while lo < len(pieces):
            hi, size = lo, 0
            while hi < len(pieces) and (hi == lo or size < GROUP):
                size += len(pieces[hi])
                hi += 1
            numbers += [self._piece(at) for at in self._numbers(pieces[lo:hi])]
            lo = hi
        first = next(begins)
        for text in texts:
            if not text:
                yield _NONE
                continue
            last = next(begins)
            yield self._document(numbers[first:last])
            first = last

    def _piece(self, numbers: list[int]) -> tuple | None:
        at = np.array(numbers, np.int64)
        sums = self._counts.rows[at].sum(axis=0)
        if sums[4] < len(at):
            return None
        first = self._first.rows[at]
        pairs, times = np.unique(self._pairs.rows[ragged(first[:, 0], first[:, 1]), 0], return_counts=True)
        return sums[:4], ";".join(map(self._text.__getitem__, numbers)).encode(), pairs, times

    def _document(self, parts: list[tuple | None]) -> tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]:
        if None in parts:
            return _NONE
        counts, groups, pairs, times = parts[0]
        digest = hashlib.sha256(groups)
        for more, groups, _, _ in parts[1:]:
            counts = counts + more
            digest.update(b";" + groups)
        if len(parts) > 1:
            pairs, at = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
            times = np.bincount(at, np.concatenate([p[3] for p in parts])).astype(np.int64)
        return tuple(counts.tolist()), digest.hexdigest(), pairs, times


_NONE = ((0, 0, 0, 0), "", np.zeros(0, np.int64), np.zeros(0, np.int64))


@lru_cache(1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_DOCUMENT = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int64())),
    ]
)
_DOCUMENT_DDL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
)


def document_aligner(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)

        def flush(rows):
            columns = [[r[0] for r in rows], *([r[1][j] for r in rows] for j in range(4)), *([r[j] for r in rows] for j in (2, 3, 4))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DOCUMENT.types)], schema=_DOCUMENT)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = np.cumsum(np.diff(texts.offsets.to_numpy()) if hasattr(texts, "offsets") else [len(x.as_buffer()) for x in texts])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + GROUP, "right")))
                found = aligner.documents(texts.slice(lo, hi - lo).to_pylist())
                yield flush([(name, *one) for name, one in zip(names[lo:hi], found)])
                lo = hi

    return run


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: how many links of the corpus hold a pair, and whether no pair with its B id has more."""
    counts = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    counts = materialize(counts.withColumn("b", F.col("pair") % width))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(pair: np.ndarray, n: np.ndarray, best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pairs")
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            times = batch.column("times").flatten().to_numpy()
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            sums = [np.diff(np.append(0, np.append(0, np.cumsum(times * x[at]))[ends])) for x in (best, n)]
            columns = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(s) for s in sums)], names=names)

    return run


def alignment_digests(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each document: tokens, groups, links, and what the corpus makes of the links."""
    aligned = materialize(_documents(documents).mapInArrow(document_aligner(path_a, path_b), _DOCUMENT_DDL))
    # at most Aligner.most_pairs rows, a property of the two vocabularies
    counts = pair_counts(aligned, _aligner(path_a, path_b).width).toPandas().sort_values("pair")
    arrays = [counts[c].to_numpy(np.int64) for c in ("pair", "n", "best")]
    ddl = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    scored = aligned.mapInArrow(_scored(*arrays), ddl)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


_LINK = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("at_a", "at_b", "id_a", "id_b", "weight"))])


def links(documents: DataFrame, path_a: str, path_b: str, kind: str = "overlap") -> DataFrame:
    """Every link of every document: ``doc_id``, the tokens' numbers ``at_a``, ``at_b`` in the document, their ids, and ``weight``.

    ``kind``: ``overlap`` (weight: bytes that both cover), ``together`` (of these, tokens that end at the same byte), or ``group``
    (tokens in one group, weight 1).
    """
    if kind not in ("overlap", "together", "group"):
        raise ValueError(f"unknown kind of link: {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                parts = [aligner._encode(aligner.words(piece)) for piece in aligner.pieces(text)] if text else []
                if not all(part[4].all() for part in parts):
                    continue
                before_a = before_b = 0
                for a, b, *_ in parts:
                    found = align(a, b, aligner._pool_a.size[a], aligner._pool_b.size[b])
                    product = found.shared if kind == "group" else found.overlap
                    a, b, weight = product.rows(), product.columns, product.values
                    if kind == "together":
                        a, b, weight = a[found.together], b[found.together], weight[found.together]
                    for lo in range(0, len(a), FLUSH):
                        x, y, w = a[lo : lo + FLUSH], b[lo : lo + FLUSH], weight[lo : lo + FLUSH]
                        columns = [x + before_a, y + before_b, found.a[x], found.b[y], w]
                        ids = pa.array([doc_id] * len(x), pa.int64())
                        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], schema=_LINK)
                    before_a += len(found.a)
                    before_b += len(found.b)

    return _documents(documents).mapInArrow(run, ", ".join(f"{f.name} bigint" for f in _LINK))
