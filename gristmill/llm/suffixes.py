"""Exact-substring dedup with a sparse, range-partitioned suffix array.

Every byte covered by a ``length``-byte string that also starts anywhere else
(another text or the same one, overlaps included) is removed.

Which suffixes: the start i of a string has the anchor A(i), the 8-gram with the
least hash among the ``WINDOW`` 8-grams from i on.  Equal strings have equal
anchors at equal offsets, so starts are compared by anchor: about one suffix in
128 bytes is kept.  An anchor serves the run of starts that choose it; all
strings of that run lie in its context, and all share the bytes of its
``lead`` (the first length - WINDOW + 1 bytes from the anchor).

1. Anchors whose lead occurs once cannot repeat and go.  Anchors whose whole
   context occurs at two places have all their starts repeated.
2. Of what is left (leads with several contexts) one suffix per context is kept.
   Suffixes are range-partitioned by their leading bytes with sampled splitters,
   and each bucket sorts them by multikey quicksort over 8-byte tokens.  Longest
   common prefixes to the right, and to the left of the anchor, give for each
   offset the classes of equal strings.
3. A group of equal leads lies in one bucket as long as it has at most
   ``bucket_rows`` contexts.  A larger one is split by the bytes behind the lead;
   its strings are compared across the bucket boundaries by 128-bit hashes, so
   the result is the same.

Equal whole texts are recognised by their digest first: all their bytes repeat
(if there are at least ``length``), and one of them stands for all from then on.

Text moves only where a small table of positions cannot be broadcast
(``broadcast_rows``, checked): each task cuts the texts that it has read.

Edge cases: null and empty texts have no bytes and lose none; texts shorter than
``length`` lose none; repeated rows are copies of each other; rows with a null
id are cut like any other; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions, ship_by_value, text_or_empty

WINDOW = 256
_GRAM = 8
_BLOCK = 1 << 20  # starts handled at once
_MIX = np.uint64(0x9E3779B97F4A7C15)
ANCHOR = "digest binary, pos int, far int, near int, lead long, context long"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def anchors(text: bytes, length: int):
    """(anchor position, greatest and least offset of the starts that choose it)."""
    last = len(text) - length
    held = None  # the anchor chosen at a block's end may go on in the next block
    for lo in range(0, last + 1, _BLOCK):
        hi = min(last, lo + _BLOCK - 1)
        part = np.frombuffer(text, np.uint8, hi - lo + WINDOW + _GRAM - 1, lo)
        grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(part, _GRAM)).view("<u8")[:, 0]
        mixed = grams * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        at = np.arange(len(grams), dtype=np.uint64)
        least = (mixed & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at)  # ties: the later one
        step = 1
        while step < WINDOW:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        chosen = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        final = np.append(first[1:], len(chosen)) - 1
        spot = chosen[first]
        found = list(zip((spot + lo).tolist(), (spot - first).tolist(), (spot - final).tolist()))
        if held and held[0] == found[0][0]:
            found[0] = (held[0], held[1], found[0][2])
        elif held:
            yield held
        held = found.pop()
        yield from found
    if held:
        yield held


def _emit_anchors(length: int):
    lead_size = length - WINDOW + 1
    h64 = xxhash.xxh3_64_intdigest

    def emit(batches):
        for batch in batches:
            digests, rows = [], []
            for digest, text in zip(batch["digest"], batch["text"]):
                before = len(rows)
                for pos, far, near in anchors(text, length):
                    rows.append((pos, far, near, h64(text[pos:pos + lead_size]),
                                 h64(text[pos - far:pos - near + length], far << 16 | near)))
                digests += [digest] * (len(rows) - before)
            table = np.array(rows, np.uint64).reshape(len(rows), 5)
            yield pd.DataFrame({"digest": pd.Series(digests, dtype=object),
                                **{c: table[:, i].astype(np.int32) for i, c in enumerate(("pos", "far", "near"))},
                                **{c: table[:, i].astype(np.int64)
                                   for i, c in ((3, "lead"), (4, "context"))}})
    return emit


def _emit_contexts(length: int):
    """Suffix (``right``) and reversed left part of each wanted anchor."""
    def emit(batches):
        for batch in batches:
            for digest, text, wanted in zip(batch["digest"], batch["text"], batch["wanted"]):
                rows = [(digest, w["pos"], w["far"], w["near"], w["shared"], w["hot"], text[w["pos"]:w["pos"] - w["near"] + length],
                         text[w["pos"] - w["far"]:w["pos"]][::-1]) for w in wanted]
                yield pd.DataFrame(rows, columns=["digest", "pos", "far", "near", "shared", "hot", "right", "left"])
    return emit


def _tokens(strings: list[bytes], size: int):
    """Zero-padded bytes (rows x size), big-endian 8-byte tokens, and true lengths."""
    width = -(-max(size, 1) // 8) * 8
    flat = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    return flat, flat.view(">u8").astype(np.uint64), np.fromiter(map(len, strings), np.int64, len(strings))


def multikey_quicksort(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Row order by tokens, then by true size: three-way partition by one token at a time."""
    order = np.arange(len(tokens))
    todo = [(0, len(order), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2:
            continue
        rows = order[lo:hi]
        if depth == tokens.shape[1]:
            order[lo:hi] = rows[np.argsort(sizes[rows], kind="stable")]
            continue
        if hi - lo <= 8:
            order[lo:hi] = rows[np.lexsort((sizes[rows], *tokens[rows, depth:].T[::-1]))]
            continue
        column = tokens[rows, depth]
        pivot = np.partition(column, len(column) // 2)[len(column) // 2]
        less, more = column < pivot, column > pivot
        a, b = int(less.sum()), int(more.sum())
        order[lo:hi] = np.concatenate([rows[less], rows[~(less | more)], rows[more]])
        todo += [(lo, lo + a, depth), (lo + a, hi - b, depth + 1), (hi - b, hi, depth)]
    return order


def _prefixes(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest common prefix of each sorted row with the row before it (-1 for the first)."""
    if len(order) < 2:
        return np.full(len(order), -1)
    out = np.empty(len(order), np.int64)
    out[0] = -1
    for lo in range(1, len(order), 4096):
        a, b = order[lo - 1:lo + 4095], order[lo:lo + 4096]
        a = a[:len(b)]
        differ = flat[a] != flat[b]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), flat.shape[1])
        out[lo:lo + 4096] = np.minimum(same, np.minimum(sizes[a], sizes[b]))
    return out


def repeated_offsets(right: list[bytes], left: list[bytes], far: np.ndarray, near: np.ndarray, length: int) -> np.ndarray:
    """(rows x WINDOW) marks: the string that starts ``offset`` bytes before the row's
    anchor equals the one at the same offset of another row."""
    n = len(right)
    marks = np.zeros((n, WINDOW), bool)
    if n < 2:
        return marks
    r_flat, r_tokens, r_sizes = _tokens(right, length)
    l_flat, l_tokens, l_sizes = _tokens(left, WINDOW)
    r_order, l_order = multikey_quicksort(r_tokens, r_sizes), multikey_quicksort(l_tokens, l_sizes)
    r_common, l_common = _prefixes(r_flat, r_sizes, r_order), _prefixes(l_flat, l_sizes, l_order)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(int(near.min()), int(far.max()) + 1):
        part = np.flatnonzero((near <= offset) & (offset <= far))
        if len(part) < 2:
            continue
        r_class[r_order] = np.cumsum(r_common < length - offset)
        l_class[l_order] = np.cumsum(l_common < offset)
        key = r_class[part] * (n + 1) + l_class[part]
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        marks[part[count[where] > 1], offset] = True
    return marks


def _runs(marks: np.ndarray):
    """(row, first, last) of every run of marks."""
    padded = np.zeros((marks.shape[0], marks.shape[1] + 2), np.int8)
    padded[:, 1:-1] = marks
    step = np.diff(padded, axis=1)
    up, down = np.argwhere(step == 1), np.argwhere(step == -1)
    return zip(up[:, 0].tolist(), up[:, 1].tolist(), (down[:, 1] - 1).tolist())


def _sort_bucket(length: int):
    """One bucket of suffixes to spans to remove, and the strings of its split groups."""
    columns = ["digest", "start", "stop", "h1", "h2", "shared"]

    def sort(batches):
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        rows = rows[~rows.duplicated(["digest", "pos"])].reset_index(drop=True)
        right, left = rows["right"].tolist(), rows["left"].tolist()
        digest, pos, shared = rows["digest"].tolist(), rows["pos"].tolist(), rows["shared"].tolist()
        far, near = rows["far"].to_numpy(np.int64), rows["near"].to_numpy(np.int64)
        marks = repeated_offsets(right, left, far, near, length)
        out = [(digest[i], pos[i] - b, pos[i] - a + length, None, None, None)
               for i, a, b in _runs(marks) if not shared[i]]
        yield pd.DataFrame(out, columns=columns)
        for i, split in enumerate(rows["hot"].tolist()):
            if split:
                whole = left[i][::-1] + right[i]
                out = []
                for offset in range(int(near[i]), int(far[i]) + 1):
                    h = xxhash.xxh3_128_intdigest(whole[far[i] - offset:far[i] - offset + length])
                    out.append((digest[i], pos[i] - offset, pos[i] - offset + length, _signed(h >> 64),
                                _signed(h & (1 << 64) - 1), bool(shared[i])))
                yield pd.DataFrame(out, columns=columns)
    return sort


def _merged(rows: pd.Series) -> pd.Series:
    """Overlapping and touching spans of each row become one."""
    out = []
    for spans in rows:
        runs = []
        for start, stop in sorted((s["start"], s["stop"]) for s in spans):
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], stop)
            else:
                runs.append([start, stop])
        out.append([{"start": a, "stop": b} for a, b in runs])
    return pd.Series(out, dtype=object)


def _cut(text: bytes | None, spans) -> tuple[int, int, bytes | None]:
    """(bytes removed, runs, what is left) of a text and its merged spans."""
    if text is None:
        return 0, 0, None
    at, kept = 0, []
    for s in spans:
        kept.append(text[at:s["start"]])
        at = s["stop"]
    kept.append(text[at:])
    left = b"".join(kept)
    return len(text) - len(left), len(spans), left


def _small(df: DataFrame, items: str, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its arrays hold at most ``limit`` items (and it has as few rows)."""
    size = df.agg(F.count("*").alias("rows"), F.sum(F.coalesce(F.size(items), F.lit(0))).alias("items")).first()
    return F.broadcast(df) if max(size["rows"], size["items"] or 0) <= limit else df


def repeated_spans(keyed: DataFrame, copies: DataFrame, scratch: Scratch, length: int, broadcast_rows: int,
                   bucket_rows: int) -> DataFrame:
    """(digest, start, stop) of removed strings, for texts that occur once as a whole.

    ``keyed``: (digest, id, text as binary); ``copies``: (digest, n, first_id)."""
    spark = keyed.sparkSession
    found = scratch.table(keyed.where(F.length("text") >= length).select("digest", "text")
                          .mapInPandas(_emit_anchors(length), ANCHOR), "anchors")
    place = F.xxhash64("digest", "pos")
    leads = (found.groupBy("lead").agg(F.min(place).alias("p0"), F.max(place).alias("p1"),
                                       F.min("context").alias("c0"), F.max("context").alias("c1"))
             .where("p0 <> p1").select(F.col("lead").alias("of"), (F.col("c0") != F.col("c1")).alias("several")))
    leads = scratch.table(leads, "leads")
    matched = scratch.table(found.join(leads, F.col("lead") == F.col("of")).drop("of"), "matched")

    # One suffix per context; a context at several places repeats as a whole.
    occurrence = F.struct("digest", "pos", "far", "near")
    contexts = scratch.table(matched.groupBy("lead", "context", "several")
                             .agg(F.min(occurrence).alias("o"), (F.min(place) != F.max(place)).alias("shared")), "contexts")
    shared = scratch.table(contexts.where("shared").select(F.col("lead").alias("of"), F.col("context").alias("with")), "shared")
    whole = (matched.join(shared, (F.col("lead") == F.col("of")) & (F.col("context") == F.col("with")))
             .select("digest", (F.col("pos") - F.col("far")).alias("start"), (F.col("pos") - F.col("near") + length).alias("stop")))

    several = contexts.where("several")
    hot = scratch.table(several.groupBy(F.col("lead").alias("of")).agg(F.count("*").alias("n"))
                        .where(F.col("n") > bucket_rows).select("of"), "hot")
    suffixes = (several.join(hot, F.col("lead") == F.col("of"), "left")
                .select("o.*", "shared", F.col("of").isNotNull().alias("hot")))
    wanted = scratch.table(suffixes.groupBy("digest").agg(
        F.collect_list(F.struct("pos", "far", "near", "shared", "hot")).alias("wanted"))
        .join(copies.select(F.col("digest").alias("c_digest"), "first_id"), F.col("digest") == F.col("c_digest"))
        .select(F.col("digest").alias("of"), "first_id", "wanted"), "wanted")
    text_rows = keyed.join(_small(wanted, "wanted", broadcast_rows), (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("first_id")))
    suffixes = scratch.table(text_rows.select("digest", "text", "wanted").mapInPandas(
        _emit_contexts(length), "digest binary, pos int, far int, near int, shared boolean, hot boolean, right binary, left binary"), "suffixes")
    buckets = max(shuffle_partitions(spark), -(-suffixes.count() // bucket_rows))
    leading = F.substring("right", 1, length - WINDOW + 1)
    split = [F.when(F.col("hot"), F.col(c)) for c in ("right", "left")]
    sorted_ = scratch.table(suffixes.repartitionByRange(buckets, leading, *split).mapInPandas(
        _sort_bucket(length), "digest binary, start int, stop int, h1 long, h2 long, shared boolean"), "sorted")
    ends = sorted_.where(F.col("h1").isNotNull())
    start = F.xxhash64("digest", "start")
    across = scratch.table(ends.groupBy(F.col("h1").alias("b1"), F.col("h2").alias("b2"))
                           .agg((F.min(start) != F.max(start)).alias("again"), F.max("shared").alias("s"))
                           .where("again").select("b1", "b2"), "across")
    boundary = (ends.where("NOT shared").join(across, (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2")))
                .select("digest", "start", "stop"))
    return whole.unionByName(sorted_.where(F.col("h1").isNull()).select("digest", "start", "stop")).unionByName(boundary)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   broadcast_rows: int = 1_000_000, bucket_rows: int = 20_000) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) per row; kept is the remaining bytes."""
    if length <= WINDOW + _GRAM:
        raise ValueError(f"length must be over {WINDOW + _GRAM}")
    scratch = Scratch(docs.sparkSession, "suffixes")
    text = text_or_empty(text_col).cast("binary")
    keyed = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    copies = scratch.table(keyed.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first_id")), "copies")
    spans = repeated_spans(keyed, copies, scratch, length, broadcast_rows, bucket_rows)
    merged = F.pandas_udf(_merged, "array<struct<start:int,stop:int>>")
    repeated = copies.where("n > 1").select(F.col("digest").alias("again"))
    spans = (spans.groupBy("digest").agg(F.collect_set(F.struct("start", "stop")).alias("all"))
             .select("digest", merged("all").alias("spans")).join(repeated, F.col("digest") == F.col("again"), "left_anti"))
    cuts = repeated.select(F.col("again").alias("of"), F.lit(True).alias("copy"),
                           F.lit(None).cast("array<struct<start:int,stop:int>>").alias("spans"))
    cuts = scratch.table(cuts.unionByName(spans.select(F.col("digest").alias("of"), F.lit(False).alias("copy"), "spans")), "cuts")

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, s) for t, s in zip(texts, found)], columns=["n_removed", "n_spans", "kept"])

    joined = keyed.join(_small(cuts, "spans", broadcast_rows), F.col("digest") == F.col("of"), "left")
    size = F.length("text").cast("long")
    touched = F.col("spans").isNotNull()
    gone = F.coalesce(F.col("copy"), F.lit(False)) & (size >= length)
    done = joined.select("id", "text", size.alias("n_bytes"), touched.alias("touched"), gone.alias("gone"),
                         cut(F.when(touched, F.col("text")), "spans").alias("c"))  # only touched texts go to Python
    return done.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(F.col("gone"), F.col("n_bytes")).otherwise(F.col("c.n_removed")).alias("n_removed"),
        F.when(F.col("gone"), F.lit(1)).otherwise(F.col("c.n_spans")).cast("long").alias("n_spans"),
        F.when(F.col("gone"), F.lit("").cast("binary")).when(F.col("touched"), F.col("c.kept"))
         .otherwise(F.col("text")).alias("kept"))


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_removed", "n_spans", "n_bytes", F.length("kept").cast("long").alias("n_kept"),
        (F.col("n_removed") > 0).alias("repeats"), F.sha2("kept", 256).alias("kept_sha256"))


ship_by_value(__name__)
