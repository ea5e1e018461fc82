"""Secrets in texts: three fixed patterns, and strings in a sensitive context that do not compress.

A candidate is a run of sixteen or more characters of ``[A-Za-z0-9+/_.-]`` (and up to two
``=`` behind it) with a sensitive word in the ``NEAR`` bytes before it.  Its novelty is what it
adds to the zstandard frame of its surroundings, in bytes per character: the compressor is
primed with a dictionary of identifiers, and the surroundings are the ``AROUND`` bytes on each
side without the candidate.  A name that stands in the dictionary or near by costs a few bytes,
a word of the text's own letters about half a byte a letter, a random string nearly a byte.

Texts are read whole, one task holds one batch of them, and nothing is shuffled.  Null and empty
texts have no spans.  Positions are code points.  Columns of the input besides the key and the
text are not read, so their names do not matter; repeated rows are scanned each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import map_texts

#: Kinds of spans in the order of equal starts; the last is the method's own.
KINDS = ("assign", "access", "hex", "novel")
# The three patterns (of bytes, so that only A-Z has two cases) and their least lengths.
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
HEX = K.lut(b"0123456789abcdef")
#: Bytes of a candidate, its least length, and the words that make a context sensitive.
LONG = K.lut(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")
LONG_MIN, NEAR, AROUND = 16, 48, 256
SENSITIVE = re.compile(rb"key|secret|token|passw|passphrase|auth|credential|bearer|private|signature|cookie|session|salt|jwt|login")
#: Bytes that a character adds; random letters and digits are above it, words and names below.
NOVELTY = 0.85
#: Names that are common in code and settings: what the compressor knows before it reads a text.
IDENTIFIERS = """
abstract access_key access_token account address admin alias anonymous api_key api_token application argument array assert async
authorization aws_access_key_id aws_secret_access_key backup base64 basic bearer boolean branch bucket buffer cache callback
certificate channel char class client client_id client_secret cloud cluster code column commit component config configuration
connection connection_string const constructor container content controller cookie credentials customer data database datetime
debug decode default default_value delete dependency description development device digest directory document domain double
download element email enable encode encoding encrypted endpoint environment error example.com exception execute expires export
extends factory false field file filename final float folder format function gateway generator global grant_type group handler
hash header host hostname http https identifier implements import index instance integer interface internal iterator json
keyboard keystore keyword lambda language library license list listener local localhost location logger login login_token manager
master message metadata method middleware migration mode model module name namespace network node notification number object
offset operation option output package parameter parent parser passphrase password path pattern payload permission placeholder
platform plugin pointer port postgres prefix private private_key process production profile project property protected protocol
provider proxy public public_key query queue random read receiver record redirect redirect_uri reference refresh_token region
registry release remote replace repository request required resource response return role root route schema scope script search
secret secret_key section security selector sender serializer server service session session_id settings shared signature source
static status storage stream string struct subject subscription suffix system table target template temporary terminal test
thread timeout timestamp token token_type tokenizer transaction transform true type undefined update upload user user_id username
value variable vector version virtual visible warning web_token window workspace write xml yaml your_api_key your_password_here
"""


def dictionary(names: str = IDENTIFIERS) -> bytes:
    """The primer: identifiers joined by blanks, also in the forms of constants and of camel case."""
    words = names.split()
    camel = ["".join(p.capitalize() for p in re.split(r"[_.]", w)) for w in words]
    return " ".join(camel + [w.upper() for w in words] + words).encode()


class Novelty:
    """Marginal compressed bytes of a string against its surroundings, under a primed compressor."""

    def __init__(self, primer: bytes, level: int = 3):
        known = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        self._frame = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False).compress

    def per_byte(self, text: bytes, start: int, end: int) -> float:
        around = text[max(0, start - AROUND) : start] + b" " + text[end : end + AROUND] + b" "
        return (len(self._frame(around + text[start:end])) - len(self._frame(around))) / (end - start)


def text_spans(text: bytes, hexes: list, runs: list, novelty: Novelty, threshold: float) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, novelty) of all spans of a text, in bytes; ``hexes`` and ``runs`` are its long runs of HEX and LONG.

    Spans of the fixed patterns are kept whatever their novelty; a candidate that touches none of them
    needs ``threshold``."""
    low = text.lower()
    out = []
    if any(w in low for w in WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                out.append((m.start(), 0, m.end(), novelty.per_byte(text, *m.span(2))))
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end(), novelty.per_byte(text, *m.span())) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(s, 2, e, novelty.per_byte(text, s, e)) for s, e in hexes]
    base = sorted((s, e) for s, _, e, _ in out)
    for s, e in runs:
        if SENSITIVE.search(low, max(0, s - NEAR), s) and not any(a < e and s < b for a, b in base):
            while e < len(text) and text[e] == 0x3D and text[e - 2 : e] != b"==":
                e += 1
            x = novelty.per_byte(text, s, e)
            if x >= threshold:
                out.append((s, 3, e, x))
    return sorted(out)


def _long(data: np.ndarray, off: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` bytes: starts, ends, and the first run of each text."""
    s, e, _ = K.words(data, off, table)
    keep = e - s >= least
    return s[keep], e[keep], np.searchsorted(s[keep], off)


def _kernel(primer: bytes, threshold: float):
    def run(batches):
        novelty = Novelty(primer)
        for b in batches:
            rows = []
            data, off = K.texts(b.column(1))
            for i, j, part, at in K.chunks(data, off):
                hs, he, hf = _long(part, at, HEX, HEX_MIN)
                rs, re_, rf = _long(part, at, LONG, LONG_MIN)
                whole = part.tobytes()
                for k in range(j - i):
                    a = int(at[k])
                    text = whole[a : int(at[k + 1])]
                    hexes = [(int(s) - a, int(e) - a) for s, e in zip(hs[hf[k] : hf[k + 1]], he[hf[k] : hf[k + 1]])]
                    runs = [(int(s) - a, int(e) - a) for s, e in zip(rs[rf[k] : rf[k + 1]], re_[rf[k] : rf[k + 1]])]
                    spans = text_spans(text, hexes, runs, novelty, threshold)
                    if spans and len(text) != (chars := np.cumsum((part[a : int(at[k + 1])] & 0xC0) != 0x80))[-1]:
                        chars = np.concatenate([[0], chars])
                        spans = [(int(chars[s]), k_, int(chars[e]), x) for s, k_, e, x in spans]
                    rows.append([{"kind": KINDS[k_], "start": s, "end": e, "novelty": x} for s, k_, e, x in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["key", "spans"])

    return run


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = NOVELTY, primer: bytes | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key`` and ``spans``, an array of (kind, start, end, novelty) by start, then kind.

    ``novelty`` is in bytes per character of the value.  An empty table gives an empty one."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    of = slim.schema["key"].dataType.simpleString()
    found = map_texts(slim, _kernel(primer or dictionary(), threshold), f"key {of}, spans array<struct<kind string, start long, end long, novelty double>>")
    return found.withColumnRenamed("key", key)


def secret_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of what ``find_secrets`` found: spans are written ``kind:start:end`` and joined by commas."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return found.select(
        key, *(n(k) for k in KINDS), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        F.round(F.array_max(F.transform("spans", lambda s: s["novelty"])), 6).alias("max_novelty"),
    )
