"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into windows that overlap by ``overlap`` code points on each
side; windows are pre-tokenised in parallel.  A pre-token boundary that two
neighbouring windows both have is a point where the later one has
resynchronised: from there on both scans see the same text, so they are equal.
The text is cut at the first such point of every overlap and the pieces, which
start and end on true boundaries, are encoded in parallel.  A window's
boundaries count only up to two code points before its end, as far as the
pattern (greedy, one code point of lookahead) cannot change them.  Where an
overlap has no common boundary (one word longer than the overlap), the rest of
the text from the last cut on is one piece, which is slower, but exact.

Texts of at most ``chunk_chars`` are one piece and need no shuffle.  Decoding
concatenates the raw bytes of the ids.

Edge cases: a null text counts as empty (no tokens); repeated rows get equal
results; an empty table gives an empty result; other columns pass through, whatever their names.
Merging a single very long pre-token takes O(n log n) steps.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, ship_by_value, text_or_empty

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_CACHED = 400_000  # pre-tokens remembered per task
_PROBES = ("a b", "1 b", "! b", "'s b", "a! 1 b", "a\nb", "é b")  # a pattern whose matches span visible and space is scanned whole
_SHORT = 64  # bytes up to which pair ranks are scanned, not queued


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _pair_ranks(ranks: dict[bytes, int], base: int) -> dict[int, int]:
    """left * base + right -> rank, for every way to put a token together from two."""
    out = {}
    get = ranks.get
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = get(token[:i]), get(token[i:])
            if a is not None and b is not None:
                out[a * base + b] = rank
    return out


def _merge_short(ids: list[int], pairs: dict[int, int], base: int) -> list[int]:
    """Merge the adjacent pair of least rank, again and again; a token's id is its rank."""
    get = pairs.get
    ranks = [get(a * base + b, base) for a, b in zip(ids, ids[1:])]
    while ranks:
        low = min(ranks)
        if low == base:
            break
        i = ranks.index(low)
        ids[i:i + 2] = [low]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = get(low * base + ids[i + 1], base)
        if i:
            ranks[i - 1] = get(ids[i - 1] * base + low, base)
    return ids


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end = list(range(1, n + 1))  # the part that starts at i ends at end[i]; 0 once it is merged away
    before = list(range(-1, n - 1))
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue  # one of the two parts has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(queue, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(queue, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec:
    """Ranks and pattern, with the ids of seen words remembered.

    No match of a pattern of this kind holds a visible character followed by
    white space.  So where no space follows other white space, a text can be cut
    before every space, and the ids of each cut (a space and the word behind it)
    do not depend on its neighbours.
    """

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks_file.splitlines()) if t}
        self.base = max(self.ranks.values()) + 1
        self.byte_rank = [self.ranks[bytes([c])] for c in range(256)]
        self.pairs = _pair_ranks(self.ranks, self.base)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.find = regex.compile(pattern).findall
        self.scan = regex.compile(pattern).finditer
        self.space_after_space = re.compile(r"\s ").search
        self.cuts_at_spaces = all(not regex.search(r"\S\s", w) for probe in _PROBES for w in self.find(probe))
        self.merged: dict[str, list[int]] = {}
        self.seen: dict[str, list[int]] = {}

    def merge(self, text: str) -> list[int]:
        ids, merged = [], self.merged.get
        for word in self.find(text):
            ids += merged(word) or self._merge_word(word)
        return ids

    def _merge_word(self, word: str) -> list[int]:
        piece = word.encode("utf-8", "replace")
        whole = self.ranks.get(piece)
        if whole is not None:
            ids = [whole]
        elif len(piece) <= _SHORT:
            byte_rank = self.byte_rank
            ids = _merge_short([byte_rank[c] for c in piece], self.pairs, self.base)
        else:
            return _merge_long(piece, self.ranks)
        if len(self.merged) >= _CACHED:
            self.merged.clear()
        self.merged[word] = ids
        return ids

    def _remember(self, word: str) -> list[int]:
        ids = self.merge(" " + word)
        if len(word) <= _SHORT:
            if len(self.seen) >= _CACHED:
                self.seen.clear()
            self.seen[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not self.cuts_at_spaces or self.space_after_space(text):
            return self.merge(text)
        first, *rest = text.split(" ")
        ids, seen = self.merge(first), self.seen.get
        for word in rest:
            ids += seen(word) or self._remember(word)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def digests(self, ids) -> tuple[int, str, str]:
        text_of = self.text_of
        return (len(ids), hashlib.sha256(",".join([text_of[i] for i in ids]).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids)).hexdigest())

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.scan(text)]


def _windows(size: int, overlap: int):
    """Rows (digest, text) to rows (digest, k, start, window): window k covers its core
    [k * size, (k + 1) * size) and ``overlap`` code points around it."""
    def cut(batches):
        for batch in batches:
            for digest, text in zip(batch["digest"], batch["text"]):
                for k, core in enumerate(range(0, len(text), size)):
                    a = max(0, core - overlap)
                    yield pd.DataFrame({"digest": [digest], "k": [k], "start": [a], "total": [len(text)],
                                        "window": [text[a:core + size + overlap]]})
    return cut


def _overlap_boundaries(shared, pattern: str, size: int, overlap: int):
    """Per window, the boundaries in its left and in its right overlap zone."""
    def scan(batches):
        codec = Codec(shared.value, pattern)
        for batch in batches:
            out = []
            for digest, k, start, total, window in zip(*(batch[c] for c in ("digest", "k", "start", "total", "window"))):
                stop = start + len(window)
                known = total if stop == total else stop - 2
                at = [start + b for b in codec.boundaries(window) if start + b <= known]
                left, right = k * size + overlap, (k + 1) * size - overlap
                out.append((digest, k, [b for b in at if k and b <= left], [b for b in at if b >= right and (k + 1) * size < total]))
            yield pd.DataFrame(out, columns=["digest", "k", "left", "right"])
    return scan


def _cuts(zones: pd.Series) -> pd.Series:
    """Cut of every window of a text; -1 from the first overlap without a common boundary on."""
    out = []
    for windows in zones:
        windows = sorted(windows, key=lambda w: w["k"])
        cuts, lost = [0], False
        for a, b in zip(windows, windows[1:]):
            common = set(a["right"]) & set(b["left"])
            lost = lost or not common
            cuts.append(-1 if lost else min(common))
        out.append(cuts)
    return pd.Series(out)


def _encode_pieces(shared, pattern: str, size: int):
    """Each window encodes [its cut, the next window's cut).  Windows behind a lost
    boundary hand their core on, for ``_finish`` to encode it as one piece."""
    def encode(batches):
        codec = Codec(shared.value, pattern)
        for batch in batches:
            out = []
            for digest, k, start, window, cuts in zip(*(batch[c] for c in ("digest", "k", "start", "window", "cuts"))):
                here, after = cuts[k], cuts[k + 1] if k + 1 < len(cuts) else start + len(window)
                core_end = min((k + 1) * size, start + len(window))
                if here >= 0 and after >= 0:
                    out.append((digest, k, codec.encode(window[here - start:after - start]), None))
                else:
                    out.append((digest, k, None, window[(here if here >= 0 else k * size) - start:core_end - start]))
            yield pd.DataFrame(out, columns=["digest", "k", "ids", "rest"])
    return encode


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
                     chunk_chars: int = 32768, overlap: int = 1024) -> DataFrame:
    """``docs`` without the text, plus n_tokens, ids_sha256 and decoded_sha256 (columns
    of these names are replaced).

    ``vocabulary`` is the path of a rank file, read by the driver and broadcast
    (its size is that of the vocabulary, not of the data).
    """
    if not 4 <= overlap < chunk_chars // 2:
        raise ValueError("overlap must be at least 4 and under half a chunk")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def whole_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(shared.value, pattern)
        for texts in batches:
            rows = [codec.digests(codec.encode(t or "")) for t in texts]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    def finish(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(shared.value, pattern)
        for texts in batches:
            rows = []
            for pieces in texts:
                ids, rest = [], []
                for p in sorted(pieces, key=lambda p: p["k"]):
                    if p["ids"] is None:
                        rest.append(p["rest"])
                    else:
                        ids.extend(p["ids"])
                rows.append(codec.digests(ids + codec.encode("".join(rest))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    whole_texts = F.pandas_udf(whole_texts, RESULT)
    finish = F.pandas_udf(finish, RESULT)
    cuts_of = F.pandas_udf(_cuts, "array<int>")
    text = text_or_empty(text_col)
    is_long = F.length(text) > chunk_chars
    keep = [c for c in docs.columns if c not in (text_col, "n_tokens", "ids_sha256", "decoded_sha256")]
    e, of, digest = fresh(docs, "e", "of", "digest")
    short = docs.where(~is_long).select(*keep, whole_texts(F.col(text_col)).alias(e)).select(*keep, f"{e}.*")

    scratch = Scratch(spark, "bpe")
    windows = scratch.table(
        docs.where(is_long).select(F.sha2(F.col(text_col), 256).alias("digest"), F.col(text_col).alias("text"))
        .mapInPandas(_windows(chunk_chars, overlap), "digest string, k int, start int, total int, window string"), "windows")
    zones = windows.mapInPandas(_overlap_boundaries(shared, pattern, chunk_chars, overlap),
                                "digest string, k int, left array<int>, right array<int>")
    one = zones.groupBy("digest", "k").agg(F.first("left").alias("left"), F.first("right").alias("right"))
    cuts = scratch.table(one.groupBy("digest").agg(F.collect_list(F.struct("k", "left", "right")).alias("zones"))
                         .select(F.col("digest").alias("of"), cuts_of("zones").alias("cuts")), "cuts")
    pieces = (windows.join(cuts, F.col("digest") == F.col("of"))
              .select("digest", "k", "start", "window", "cuts")
              .mapInPandas(_encode_pieces(shared, pattern, chunk_chars), "digest string, k int, ids array<int>, rest string"))
    one = pieces.groupBy("digest", "k").agg(F.first("ids").alias("ids"), F.first("rest").alias("rest"))
    encoded = scratch.table(one.groupBy("digest").agg(F.collect_list(F.struct("k", "ids", "rest")).alias("pieces"))
                            .select(F.col("digest").alias(digest), finish("pieces").alias(e)), "encoded")
    long = (docs.where(is_long).select(*keep, F.sha2(F.col(text_col), 256).alias(of))
            .join(encoded, F.col(of) == F.col(digest)))
    return short.unionByName(long.select(*keep, f"{e}.*"))


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


ship_by_value(__name__)
