"""Exact SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

A merge-type model joins the best-scoring adjacent pair of symbols, leftmost
first, until no pair makes a piece. A cut of a text into pieces is that result
exactly when every two neighbours, merged again from their characters, come
out as these two. So a text is encoded left to right: the longest piece that
starts here (from Aho-Corasick matches) is tried, then its shorter prefixes;
a piece is taken if it is compatible with the one before and its end is not
known to fail; where nothing fits, the place is marked in a bitfield and the
last piece is taken back. Compatibility is remembered for each pair. Characters
without a piece become bytes.

How it is spread: no piece holds certain neighbours (a letter and a blank after
it, anything next to a newline), so texts fall into parts there, whose pieces
don't depend on what surrounds them. The neighbours are read from the
vocabulary. Each Python worker encodes a part once and remembers the ids of the
parts it met last; texts are handled in chunks, with no shuffle.

Defined results: a NULL or empty text has the begin and end ids alone and
decodes to an empty text; repeated rows and ids get equal results; a NULL id is
kept; an empty table gives an empty result; other columns are ignored. A text
of any length, with or without blanks, is encoded whole in linear time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from corpuscheck.llm.tables import narrow
from corpuscheck.llm.words import U64, Chunk, chunks, hash_spans, mix

#: Parts whose ids a Python worker remembers, in each of two generations.
CACHE_PARTS = 400_000
#: Pairs of pieces whose compatibility is remembered.
CACHE_PAIRS = 1_000_000
#: Bytes of text encoded at once.
CHUNK_BYTES = 4_000_000
SPACE = "▁"
# Piece types of the model's file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces of a merge-type model, their scores, matches and compatibility."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, rules = proto.trainer_spec, proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("needs a merge-type model without text normalisation")
        if spec.treat_whitespace_as_suffix or kinds & {_USER, _UNUSED}:
            raise ValueError("models with user-defined or unused pieces, or blanks as suffixes, are not supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.dummy = SPACE if rules.add_dummy_prefix else ""
        self.id_of = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.byte_id = np.zeros(256, np.uint32)
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
        self.byte_fallback = spec.byte_fallback
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.begin, self.end = self._control(spec.bos_piece), self._control(spec.eos_piece)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, i << 8 | len(piece))
        self.automaton.make_automaton()
        self.width = [len(p) for p in self.pieces]
        self.length = np.array(self.width, np.int64)
        self._shorter: dict[int, int] = {}
        self._alone: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}
        # ASCII neighbours that some piece holds
        self.joined = np.zeros((128, 128), bool)
        for piece in self.id_of:
            plain = piece.replace(SPACE, " ")
            for a, b in zip(plain, plain[1:]):
                if a < "\x80" and b < "\x80":
                    self.joined[ord(a), ord(b)] = True

    def _control(self, piece: str) -> int:
        return self.pieces.index(piece)

    def merge(self, text: str) -> list[str]:
        """The model's own rule: join the best pair, leftmost first, until none is a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    # A character without a piece is the token -1 - its code point.

    def text(self, token: int) -> str:
        return self.pieces[token] if token >= 0 else chr(-1 - token)

    def alone(self, token: int) -> bool:
        """Does merging the piece's own characters give it back?"""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = token < 0 or len(self.merge(self.pieces[token])) == 1
        return known

    def fits(self, left: int, right: int) -> bool:
        """Does merging both pieces' characters again give these two?"""
        key = (left + (1 << 22)) << 24 | (right + (1 << 22))
        known = self._pairs.get(key)
        if known is None:
            a, b = self.text(left), self.text(right)
            known = self._pairs[key] = self.merge(a + b) == [a, b]
        return known

    def shorter(self, token: int) -> int | None:
        """The next shorter token that begins ``token``; a single character is the last."""
        if token < 0 or len(self.pieces[token]) == 1:
            return None
        known = self._shorter.get(token)
        if known is None:
            piece = self.pieces[token]
            known = next((self.id_of[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id_of), -1 - ord(piece[0]))
            if len(piece) > 1 and known >= 0 and len(self.pieces[known]) == 1 and piece[0] not in self.id_of:
                known = -1 - ord(piece[0])
            self._shorter[token] = known
        return known

    def longest(self, text: str) -> np.ndarray:
        """The longest piece's token starting at each character (Aho-Corasick matches)."""
        found = np.fromiter((end << 32 | piece for end, piece in self.automaton.iter(text)), np.int64)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        out = -1 - points
        if len(found):
            n = (found & 255).astype(np.uint8)
            found = found[np.argsort(n, kind="stable")]
            # of the matches that start here, the longest is written last
            out[(found >> 32) - (found & 255) + 1] = (found & 0xFFFFFFFF) >> 8
        return out

    def backtrack(self, longest: list[int]) -> list[int]:
        """Tokens of a text from the longest match at each of its characters."""
        size = len(longest)
        failed = bytearray(size // 8 + 1)
        tokens: list[int] = []
        pairs, alone, width, fits = self._pairs, self._alone, self.width, self.fits
        at, token = 0, longest[0] if size else None
        while token is not None:
            last = tokens[-1] if tokens else None
            while True:
                end = at + (width[token] if token >= 0 else 1)
                if not failed[end >> 3] >> (end & 7) & 1 and (alone.get(token) or self.alone(token)) and (
                        last is None or pairs.get((last + (1 << 22)) << 24 | (token + (1 << 22))) or fits(last, token)):
                    tokens.append(token)
                    at = end
                    token = longest[at] if at < size else None
                    break
                less = self.shorter(token)
                if less is not None:
                    token = less
                    continue
                failed[at >> 3] |= 1 << (at & 7)
                if last is None:
                    raise ValueError("no cut of the text is the model's")
                tokens.pop()
                at -= width[last] if last >= 0 else 1
                token = last
                break
        return tokens

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all parts end to end, number of tokens of each part).

        Taking the longest match everywhere is the first path that
        backtracking tries; it is followed for all parts at once, and only
        parts where a piece doesn't fit go on one by one.
        """
        if len(self._pairs) > CACHE_PAIRS:
            self._pairs.clear()
        size = np.array([len(p) for p in parts], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        longest = self.longest("".join(parts))
        # a match may not reach over a part's end
        width = np.where(longest >= 0, self.length[np.maximum(longest, 0)], 1)
        over = np.flatnonzero(np.arange(first[-1]) + width > np.repeat(first[1:], size))
        ends = np.repeat(first[1:], size)[over] if len(over) else over
        for i, e in zip(over.tolist(), ends.tolist()):
            t = int(longest[i])
            while t >= 0 and i + len(self.pieces[t]) > e:
                t = self.shorter(t)
            longest[i] = t
        width = np.where(longest >= 0, self.length[np.maximum(longest, 0)], 1)
        at, doc = first[:-1][size > 0], np.flatnonzero(size > 0)
        good = np.ones(len(parts), bool)
        last = np.full(len(at), 1 << 40, np.int64)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            token = longest[at]
            ok = self._all_fit(last, token)
            good[doc[~ok]] = False
            at, doc, token = at[ok], doc[ok], token[ok]
            steps.append((doc, token))
            at = at + width[at]
            more = at < first[doc + 1]
            at, doc, last = at[more], doc[more], token[more]
        of = np.concatenate([d for d, _ in steps]) if steps else np.zeros(0, np.int64)
        tokens = np.concatenate([t for _, t in steps]) if steps else np.zeros(0, np.int64)
        keep = good[of]
        of, tokens = of[keep], tokens[keep]
        slow = np.flatnonzero(~good)
        if len(slow):
            more, many = [], []
            for k in slow.tolist():
                found = self.backtrack(longest[first[k]:first[k + 1]].tolist())
                more += found
                many.append(len(found))
            of = np.concatenate([of, np.repeat(slow, many)])
            tokens = np.concatenate([tokens, np.array(more, np.int64)])
        order = np.argsort(of, kind="stable")
        return tokens[order], np.bincount(of, minlength=len(parts)).astype(np.int64)

    def _all_fit(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys, back = np.unique((last << 22) + (token + (1 << 21)), return_inverse=True)
        ok = np.empty(len(keys), bool)
        for i, key in enumerate(keys.tolist()):
            left, right = key >> 22, (key & ((1 << 22) - 1)) - (1 << 21)
            ok[i] = self.alone(right) and (left == 1 << 40 or self.fits(left, right))
        return ok[back]

    def ids(self, tokens: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model ids of tokens (``count`` for each part), characters without a piece as bytes."""
        lost = np.flatnonzero(tokens < 0)
        if not len(lost):
            return tokens.astype(np.uint32), count
        if not self.byte_fallback:
            return np.where(tokens < 0, self.unknown, tokens).astype(np.uint32), count
        raw = [self.byte_id[np.frombuffer(chr(-1 - int(t)).encode("utf-8", "surrogatepass"), np.uint8)] for t in tokens[lost]]
        wide = np.ones(len(tokens), np.int64)
        wide[lost] = [len(r) for r in raw]
        out = np.repeat(np.maximum(tokens, 0), wide).astype(np.uint32)
        out[np.repeat(tokens < 0, wide)] = np.concatenate(raw)
        total = np.concatenate([[0], np.cumsum(wide)])
        part = np.concatenate([[0], np.cumsum(count)])
        return out, np.diff(total[part])

    def encode(self, text: str) -> list[int]:
        """Ids of one text without begin and end."""
        if not text:
            return []
        part = self.dummy + text.replace(" ", SPACE)
        return self.ids(*self.encode_parts([part]))[0].tolist()


class PartIds:
    """Ids of the parts met last, by hash: sorted keys over one array of ids.

    Two generations: when the young one is full it becomes the old one, and
    parts found there move on to the young one, so frequent parts stay.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = CACHE_PARTS):
        self.vocabulary, self.limit = vocabulary, limit
        self.young, self.old = self._empty(), self._empty()

    @staticmethod
    def _empty():
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def _look(generation, keys):
        held = generation[0]
        if not len(held):
            return np.full(len(keys), -1)
        k = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        return np.where(held[k] == keys, k, -1)

    @staticmethod
    def _gather(ids, at, n):
        total = np.concatenate([[0], np.cumsum(n)])
        return ids[np.repeat(at - total[:-1], n) + np.arange(total[-1])]

    def find(self, keys: np.ndarray, text_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, number, ids) of each of the ascending, distinct ``keys``."""
        if len(self.young[0]) > self.limit:
            self.young, self.old = self._empty(), self.young
        new = np.flatnonzero(self._look(self.young, keys) < 0)
        if len(new):
            at_old = self._look(self.old, keys[new])
            known, rest = np.flatnonzero(at_old >= 0), np.flatnonzero(at_old < 0)
            n = np.zeros(len(new), np.int64)
            n[known] = self.old[2][at_old[known]]
            made = np.zeros(0, np.uint32)
            if len(rest):
                made, n[rest] = self.vocabulary.ids(*self.vocabulary.encode_parts([text_of(k) for k in new[rest].tolist()]))
            moved = self._gather(self.old[3], self.old[1][at_old[known]], n[known]) if len(known) else made[:0]
            at = np.empty(len(new), np.int64)
            base = len(self.young[3])
            at[known] = base + np.cumsum(n[known]) - n[known]
            at[rest] = base + len(moved) + np.cumsum(n[rest]) - n[rest]
            place = np.searchsorted(self.young[0], keys[new])
            self.young = (np.insert(self.young[0], place, keys[new]), np.insert(self.young[1], place, at),
                          np.insert(self.young[2], place, n), np.concatenate([self.young[3], moved, made]))
        k = np.searchsorted(self.young[0], keys)
        return self.young[1][k], self.young[2][k], self.young[3]


def part_ids(path: str) -> PartIds:
    """This Python process's vocabulary and remembered parts; they outlive a task, not the worker."""
    held = vars(sentencepiece).setdefault("_part_ids", {})
    if path not in held:
        held[path] = PartIds(Vocabulary(path))
    return held[path]


def part_starts(data: np.ndarray, bounds: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Bytes where a part starts: a document's first, and ASCII neighbours that no piece holds."""
    cut = np.zeros(len(data), bool)
    low = data < 0x80
    both = low[1:] & low[:-1]
    cut[1:] = both & ~joined[np.where(both, data[:-1], 0), np.where(both, data[1:], 0)]
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def token_ids(chunk: Chunk, memory: PartIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids end to end without begin and end, first id of each document)."""
    data, bounds = chunk.data, chunk.bounds
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(chunk) + 1, np.int64)
    vocabulary = memory.vocabulary
    start = part_starts(data, bounds, vocabulary.joined)
    end = np.append(start[1:], len(data))
    keys = hash_spans(data, start, end)
    # a document's first part has the blank that the model puts before a text
    leads = np.zeros(len(data), bool)
    leads[bounds[:-1][bounds[:-1] < len(data)]] = True
    lead = leads[start]
    keys[lead] = mix(keys[lead] ^ U64(0xA0761D6478BD642F))
    keys, sample, back = np.unique(keys, return_index=True, return_inverse=True)

    def text_of(k: int) -> str:
        i = sample[k]
        part = data[start[i]:end[i]].tobytes().decode("utf-8", "replace").replace(" ", SPACE)
        return vocabulary.dummy + part if lead[i] else part

    at, n, ids = memory.find(keys, text_of)
    size = n[back]
    total = np.concatenate([[0], np.cumsum(size)])
    out = ids[np.repeat(at[back] - total[:-1], size) + np.arange(total[-1])]
    return out, total[np.searchsorted(start, bounds)]


_CODED = "doc_id long, n_tokens long, ids binary"
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[Chunk, list[bytes]]]:
    memory = part_ids(path)
    begin, end = (np.array([i], np.uint32) for i in (memory.vocabulary.begin, memory.vocabulary.end))
    for c in chunks(batches, max_bytes=CHUNK_BYTES):
        ids, first = token_ids(c, memory)
        yield c, [np.concatenate([begin, ids[first[i]:first[i + 1]], end]).astype("<u4").tobytes() for i in range(len(c))]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: ids with begin and end as little-endian unsigned 32-bit integers."""
    where = path or model_path()

    def run(bs):
        for c, rows in _encoded(bs, where):
            for i in range(0, len(rows), 5000):
                some = rows[i:i + 5000]
                yield pa.RecordBatch.from_arrays(
                    [c.rows.column("doc_id").combine_chunks().slice(i, len(some)), pa.array([len(r) // 4 for r in some], pa.int64()),
                     pa.array(some, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return narrow(docs).mapInArrow(run, _CODED)


def decoder(path: str):
    """The library's own ``decode`` of little-endian ids."""
    held = vars(sentencepiece).setdefault("_decoders", {})
    if path not in held:
        held[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda raw: held[path].decode(np.frombuffer(raw, "<u4").tolist())


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of rows of ``encode_documents``."""
    where = path or model_path()

    def run(bs):
        decode = decoder(where)
        for b in bs:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([decode(r or b"") for r in b.column("ids").to_pylist()], pa.string())],
                                             names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of whole texts, encoded and decoded again."""
    where = path or model_path()

    def run(bs):
        decode = decoder(where)
        for c, rows in _encoded(bs, where):
            sha = [hashlib.sha256(r).hexdigest() for r in rows]
            back = [hashlib.sha256(decode(r).encode()).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays([c.rows.column("doc_id").combine_chunks(), pa.array([len(r) // 4 for r in rows], pa.int64()),
                                              pa.array(sha), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow(docs).mapInArrow(run, _DIGEST)


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded with begin and end ids, and decoded again."""
    from corpuscheck.llm.tables import read

    return digests(read(spark, sf_dir, "documents"))
