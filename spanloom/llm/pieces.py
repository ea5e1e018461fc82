"""SentencePiece encoding and decoding that keeps the offsets of the original text.

The normaliser follows the model's compiled character map: at each place the longest
prefix in its double-array trie is replaced, and every normalised byte records the
source byte it came from.  Pieces are byte pairs merged by score; no merge can cross a
place where no piece has the two characters side by side, so texts are cut there and
each distinct cut is merged once per task.  Every piece is then projected through the
recorded alignment to a span of original bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import map_texts

SPACE = "▁"
_SP = SPACE.encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Distinct cuts that a task remembers (about 300 bytes each), and forgets when it ends:
#: a reused worker must not keep them while it serves other stages.
CACHE = 120_000


class CharMap:
    """Longest-prefix replacement through a compiled character map (trie size, trie, strings)."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4)) if blob else []
        self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``text[at:]`` and its replacement."""
        u = self.units
        if not u:
            return None
        node, found = 0, None
        unit = u[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(text)):
            c = text[i]
            node ^= c
            if node >= len(u):
                break
            unit = u[node]
            if unit & 0x800000FF != c:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, u[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.strings.index(b"\0", found[1])
        return found[0], self.strings[found[1] : end]


class Pieces:
    """A BPE model read from its file's bytes."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(blob)
        if m.trainer_spec.model_type != 2:
            raise ValueError("only BPE models are supported")
        norm = m.normalizer_spec
        self.map = CharMap(norm.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        if m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with blanks at the end of words are not supported")
        self.bytes_for_unknown = m.trainer_spec.byte_fallback
        if not self.bytes_for_unknown:
            raise ValueError("models without pieces for single bytes are not supported")
        self.unk_surface = m.trainer_spec.unk_surface.encode()
        self.id: dict[str, int] = {}
        self.score: list[float] = []
        self.byte_id = [0] * 256
        self.unk = 0
        surface, kinds = [], []
        for i, p in enumerate(m.pieces):
            self.score.append(p.score)
            kinds.append(p.type)
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_id[value] = i
                surface.append(bytes([value]))
            elif p.type == UNKNOWN:
                self.unk = i
                surface.append(self.unk_surface)
            elif p.type == CONTROL:
                surface.append(b"")
            elif p.type in (USER, UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            else:
                self.id[p.piece] = i
                surface.append(p.piece.replace(SPACE, " ").encode())
        # pieces of equal score have equal ranks, so that the leftmost wins
        order = {v: i for i, v in enumerate(sorted({self.score[k] for k in self.id.values()}, reverse=True))}
        self.rank = {p: order[self.score[k]] for p, k in self.id.items()}
        self.no_rank = len(order)
        self.kind = np.array(kinds, np.int8)
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.size = np.array([len(s) for s in surface], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.blank_first = np.array([k == NORMAL and p.piece.startswith(SPACE) for k, p in zip(kinds, m.pieces)])
        inside = "".join(self.id)
        lone = "".join(c for c in "\n\t\r" if c not in inside)  # characters of no piece
        after = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        cut = f"[{lone}]|" if lone else ""
        # where no piece goes on with a blank after another character, words can be cut apart
        self.cuts = re.compile(f"{cut}{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" if not after else (f"{cut}[^{lone}]+" if lone else r"(?s).+"))
        self.known: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.known = {}
        self._ids: list[int] = []
        self._lens: list[int] = []
        self._at: list[int] = [0]
        self._arrays = None

    # ---- normalisation ------------------------------------------------------------

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the original byte offset."""
        raw = text.encode()
        if not raw:
            return b"", np.zeros(1, np.int64)
        if self.map.units or self.squeeze or not self.escape:
            return self._normalize_mapped(raw)
        data = np.frombuffer(raw, np.uint8)
        blank = data == 32
        at = np.repeat(np.arange(len(data)), np.where(blank, 3, 1))
        norm = raw.replace(b" ", _SP)
        if self.dummy:
            return _SP + norm, np.concatenate([np.zeros(3, np.int64), at, [len(raw)]])
        return norm, np.concatenate([at, [len(raw)]])

    def _normalize_mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        def step(i: int) -> tuple[int, bytes]:
            hit = self.map.longest(raw, i)
            if hit:
                return hit
            b = raw[i]
            n = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            return n, raw[i : i + n]

        i = 0
        if self.squeeze:
            while i < len(raw):
                n, rep = step(i)
                if rep != b" ":
                    break
                i += n
        blank = _SP if self.escape else b" "
        out, at = bytearray(), []
        if i == len(raw):
            return b"", np.array([i])
        if self.dummy:
            out += blank
            at += [i] * len(blank)
        last_blank = self.squeeze
        while i < len(raw):
            n, rep = step(i)
            if last_blank:
                rep = rep.lstrip(b" ")
            if rep:
                for c in rep:
                    if c == 32:
                        out += blank
                        at += [i] * len(blank)
                    else:
                        out.append(c)
                        at.append(i)
                last_blank = self.squeeze and rep.endswith(b" ")
            i += n
        end = len(raw)
        if self.squeeze:
            while out.endswith(blank):
                end = at[len(out) - len(blank)]
                del out[len(out) - len(blank) :]
        del at[len(out) :]
        return bytes(out), np.array([*at, end])

    # ---- merging ------------------------------------------------------------------

    def merge(self, s: str) -> list[str]:
        """Byte-pair merges of one cut: best score first, then leftmost."""
        if len(s) > 64:
            return self._merge_long(s)
        rank, none = self.rank.get, self.no_rank
        sym = list(s)
        if len(sym) < 2:
            return sym
        best = [rank(a + b, none) for a, b in zip(sym, sym[1:])]
        while True:
            low = min(best)
            if low == none:
                return sym
            i = best.index(low)
            sym[i] += sym.pop(i + 1)
            del best[i]
            if not best:
                return sym
            if i:
                best[i - 1] = rank(sym[i - 1] + sym[i], none)
            if i < len(best):
                best[i] = rank(sym[i] + sym[i + 1], none)

    def _merge_long(self, s: str) -> list[str]:
        """The same with a queue, for cuts in which scanning for the best pair would be slow."""
        sym: list[str | None] = list(s)
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []
        get, score = self.id.get, self.score

        def offer(i: int, j: int) -> None:
            both = sym[i] + sym[j]
            k = get(both)
            if k is not None:
                heapq.heappush(heap, (-score[k], i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if sym[i] is None or sym[j] is None or after[i] != j or len(sym[i]) + len(sym[j]) != len(both):
                continue
            sym[i], sym[j] = both, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x in sym if x is not None]

    def _learn(self, cut: str) -> int:
        """Number of the cut; its ids and their normalised bytes go to the flat tables."""
        for p in self.merge(cut):
            k = self.id.get(p)
            raw = p.encode()
            if k is not None:
                self._ids.append(k)
                self._lens.append(len(raw))
            else:
                self._ids += [self.byte_id[b] for b in raw]
                self._lens += [1] * len(raw)
        number = self.known[cut] = len(self._at) - 1
        self._at.append(len(self._ids))
        self._arrays = None
        return number

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins, ends (original bytes) of all texts, and offsets by text."""
        if len(self.known) > CACHE:
            self._reset()
        cuts, per_text, align = [], [], []
        known, learn = self.known.get, self._learn
        for t in texts:
            norm, at = self.normalize(t or "")
            own = []
            for c in self.cuts.findall(norm.decode()):
                k = known(c)
                own.append(learn(c) if k is None else k)
            cuts.append(np.array(own, np.int64))
            per_text.append(len(own))
            align.append(at)
        if self._arrays is None:
            self._arrays = (np.array(self._ids, np.int32), np.array(self._lens, np.int64), np.array(self._at, np.int64))
        ids, lens, start = self._arrays
        flat = np.concatenate(cuts) if cuts else np.zeros(0, np.int64)
        n = start[flat + 1] - start[flat]
        total = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(start[flat] - total[:-1], n) + np.arange(total[-1])
        off = total[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
        # normalised offsets run on from text to text; so do the joined alignments, with one entry more for each text
        norm_end = np.cumsum(lens[take])
        norm_begin = norm_end - lens[take]
        text_of = np.repeat(np.arange(len(texts)), np.diff(off))
        joined = np.concatenate(align) if align else np.zeros(0, np.int64)
        return ids[take], joined[norm_begin + text_of], joined[norm_end + text_of], off

    # ---- decoding -----------------------------------------------------------------

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the decoded texts and their offsets; ids of each text are ``ids[off[i]:off[i + 1]]``."""
        size = self.size[ids]
        start = self.start[ids]
        first = off[:-1][np.diff(off) > 0]
        if self.dummy or self.squeeze:  # the blank that encoding put before the text
            lead = first[self.blank_first[ids[first]]]
            size[lead] -= 1
            start[lead] += 1
        total = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(start - total[:-1], size) + np.arange(total[-1])
        out, ends = self.surface[take], total[off]
        lone = np.flatnonzero(self.kind[ids] == BYTE)
        if len(lone):
            # each text that holds a byte piece is judged alone: bytes never join across a border of texts
            parts = [out[i:j] for i, j in zip(ends[:-1], ends[1:])]
            for i in np.unique(np.searchsorted(off, lone, "right") - 1).tolist():
                if not _valid(parts[i]):
                    parts[i] = np.frombuffer(self._repair(parts[i].tobytes()), np.uint8)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
            out = np.concatenate(parts)
        return out, ends

    def _repair(self, text: bytes) -> bytes:
        """Bytes that form no character become U+FFFD, one for each byte."""
        out, i = [], 0
        while i < len(text):
            b = text[i]
            n = 1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
            try:
                out.append(text[i : i + n].decode() if n else "�")
            except UnicodeDecodeError:
                out.append("�")
                n = 1
            i += n or 1
        return "".join(out).encode()


def _valid(data: np.ndarray) -> bool:
    try:
        data.tobytes().decode()
        return True
    except UnicodeDecodeError:
        return False


_models: dict[bytes, Pieces] = {}


def _model(blob: bytes) -> Pieces:
    """One model per task: a reused worker must not keep it while it serves other stages."""
    key = str(hash(blob)).encode()
    if key not in _models:
        _models.clear()
        _models[key] = Pieces(blob)
    return _models[key]


def _lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values.astype(np.int32)))


def _batches(batches, blob: bytes, decode: bool) -> Iterator[pa.RecordBatch]:
    model = _model(blob)
    for b in batches:
        column = b.column("text")
        _, off = K.texts(column)
        i, n = 0, b.num_rows
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + K.CHUNK, "right")) - 1))
            ids, begin, end, at = model.encode(column.slice(i, j - i).to_pylist())
            cols = [b.column("doc_id").slice(i, j - i).cast(pa.int64()), _lists(ids, at), _lists(begin, at), _lists(end, at)]
            names = ["doc_id", "ids", "begins", "ends"]
            if decode:
                out, ends = model.decode(ids, at)
                cols.append(pa.StringArray.from_buffers(j - i, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(out))))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(cols, names)
            i = j
    _models.clear()


def encode_documents(docs: DataFrame, model: bytes, *, decode: bool = True) -> DataFrame:
    """Encode every whole text: ``doc_id, ids, begins, ends`` and, with ``decode``, ``decoded``.

    ``begins`` and ``ends`` are byte offsets in the original text.  ``model`` is the content
    of the model's file (bounded: a vocabulary, not data).  Reads ``doc_id`` and ``text``;
    other columns are ignored.  A null or empty text has no pieces and decodes to the empty
    text; a null ``doc_id`` stays null; repeated rows give repeated results; an empty table
    gives an empty one."""
    schema = "doc_id long, ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decode
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_texts(docs, lambda it: _batches(it, model, decode), schema)


def _decode_batches(batches, blob: bytes):
    model = _model(blob)
    for b in batches:
        ids = b.column("ids")
        values = ids.fill_null([]) if ids.null_count else ids
        off = np.concatenate([[0], np.cumsum(values.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
        out, ends = model.decode(values.flatten().to_numpy().astype(np.int64), off)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.StringArray.from_buffers(b.num_rows, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(out)))],
            ["doc_id", "decoded"],
        )


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """Texts of ``ids``: ``doc_id, decoded``.

    Reads ``doc_id`` and ``ids`` alone.  Null or empty ids decode to the empty text; bytes
    that form no character become U+FFFD, judged within a text; a null ``doc_id`` stays
    null; repeated rows give repeated results; an empty table gives an empty one."""
    encoded = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return map_texts(encoded, lambda it: _decode_batches(it, model), "doc_id long, decoded string")
