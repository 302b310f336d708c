"""Verdicts on web addresses by a sorted digest array.

A list has entries of two kinds, each with a verdict: *sites* (host and beginning of a path, which hold for the host
and all its subdomains) and *words* (which hold for hosts one of whose parts between other characters than letters and digits is the word).
Every entry is a string under a 64-bit xxhash. Spark sorts the entries by hash and packs them into volumes: hashes in
order, then offsets, verdicts and the full strings. Each volume is a file in the shared folder that every executor fetches
once; the workers of a machine map the same file into memory, so a list costs each of them no memory of its own
beyond the pages that probes touch.

An address is turned into the strings that could be entries: for each number of host labels and each length of
path that some site has, that suffix of the host with that beginning of the path, and the words of the host. All
strings of a batch of addresses are hashed, looked for by one binary search over the mapped hashes, and confirmed against the full
string; entries of equal hash stand side by side and each is tried. The longest site decides (of two equally long ones the first in order); without a site a
word that blocks blocks; without any the address is allowed.

Bounds. The list is an input of its own, not of the corpus: at most ``MAX_ENTRIES`` entries, counted before it is written,
else an error. The driver copies one volume at a time.

Defined cases: a null address or one without ``://`` has an empty host and path, no rule, and is allowed; addresses of any length
are read whole; repeated rows give as many rows; of repeated entries the blocking one counts; an empty list allows all.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import stored
from tallyworks.session import new_folder

MAX_ENTRIES = 20_000_000
VOLUME_ENTRIES = 1_000_000
SEED = 42
SITE, WORD = "/", "="
ALLOW, BLOCK = "allow", "block"
# rows of addresses whose strings are probed together
PROBE_ROWS = 2000

# Words of hosts that stand for sites one does not train on
WORDS = "adult bet bets casino casinos escort escorts gambling hentai jackpot lottery pills poker porn porno sex slots spam torrent torrents viagra warez xxx ads".split()


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host, A-Z in lower case, and path; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join([c.lower() if "A" <= c <= "Z" else c for c in host]), path


# --- the digest array


def entries(spark: SparkSession, sites: Sequence[tuple[str, str]], words: Sequence[str] = WORDS) -> DataFrame:
    """``entry, verdict`` of sites ``(host and path, verdict)`` and blocking words."""
    rows = [(SITE + s, v) for s, v in sites] + [(WORD + w, BLOCK) for w in words]
    return spark.createDataFrame(rows, "entry string, verdict string")


def _volume(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of their hash -> one volume: number, hashes, offsets, verdicts, strings."""
    lots = [b for b in batches if b.num_rows]
    if not lots:
        return
    table = pa.Table.from_batches(lots)
    digests = table.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(digests, kind="stable")
    texts = [table.column(1)[int(i)].as_py().encode() for i in order]
    blocks = np.array([table.column(2)[int(i)].as_py() == BLOCK for i in order], np.uint8)
    offsets = np.cumsum([0, *map(len, texts)]).astype("<u8")
    parts = [np.array([len(texts)], "<u8"), digests[order].astype("<u8"), offsets, blocks]
    data = b"".join([p.tobytes() for p in parts]) + b"".join(texts)
    yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["volume"])


class DigestArray:
    """Volumes of a list, mapped from their files."""

    def __init__(self, paths: Sequence[str]):
        self.volumes = []
        for path in paths:
            data = np.memmap(path, np.uint8, "r")
            n = int(data[:8].view("<u8")[0])
            digests, offsets = data[8 : 8 + 8 * n].view("<u8"), data[8 + 8 * n : 16 + 16 * n].view("<u8")
            self.volumes.append((digests, offsets, data[16 + 16 * n : 16 + 17 * n], data[16 + 17 * n :]))

    def probe(self, texts: Sequence[str]) -> np.ndarray:
        """For each string 1 if an entry blocks it, 0 if one allows it, -1 if none is equal to it."""
        import xxhash

        raw = [t.encode() for t in texts]
        keys = np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in raw), np.uint64, len(raw))
        found = np.full(len(raw), -1, np.int8)
        for digests, offsets, blocks, strings in self.volumes:
            at, end = np.searchsorted(digests, keys, "left"), np.searchsorted(digests, keys, "right")
            for i in np.flatnonzero(end > at).tolist():
                for j in range(at[i], end[i]):
                    if strings[int(offsets[j]) : int(offsets[j + 1])].tobytes() == raw[i]:
                        found[i] = max(found[i], blocks[j])
        return found


def write_list(listed: DataFrame, volume_entries: int = VOLUME_ENTRIES, max_entries: int = MAX_ENTRIES) -> tuple[list[str], list[tuple[int, int]]]:
    """Volumes of ``entry, verdict`` rows given to the executors: names of the files, and (host labels, path length) of the sites."""
    spark = listed.sparkSession
    keyed = listed.where("entry IS NOT NULL").groupBy("entry").agg(F.max(F.when(F.col("verdict") == BLOCK, BLOCK).otherwise(ALLOW)).alias("verdict"))
    keyed = stored(keyed.select(F.xxhash64("entry").alias("digest"), "entry", "verdict"), "url-entries")
    n = keyed.count()
    if n > max_entries:
        raise ValueError(f"the list has {n} entries, the bound is {max_entries}")
    site = F.substr("entry", F.lit(2))
    host = F.substring_index(site, "/", 1)
    shapes = keyed.where(F.col("entry").startswith(SITE)).select(
        F.size(F.split(host, "\\.")).alias("labels"), (F.char_length(site) - F.char_length(host)).alias("chars")
    )
    shapes = sorted((r.labels, r.chars) for r in shapes.distinct().collect())
    volumes = keyed.repartitionByRange(max(1, -(-n // volume_entries)), "digest").mapInArrow(_volume, "volume binary")
    folder, names = new_folder(spark, "url-list"), []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for row in volumes.toLocalIterator():
        names.append(f"urls-{uuid.uuid4().hex}")
        path = hadoop(f"{folder}/{names[-1]}")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        for i in range(0, len(row.volume), 1 << 22):
            out.write(bytearray(row.volume[i : i + (1 << 22)]))
        out.close()
        spark.sparkContext.addFile(path.toString())
    return names, shapes


# --- addresses


def site_strings(host: str, path: str, shapes: Sequence[tuple[int, int]]) -> list[str]:
    """The sites that could fit an address, longest first."""
    found = []
    labels = host.split(".")
    for n, chars in shapes:
        if n <= len(labels) and chars <= len(path):
            found.append(".".join(labels[len(labels) - n :]) + path[:chars])
    return sorted(set(found), key=lambda s: (-len(s), s))


def _judge(names: list[str], shapes: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray([SparkFiles.get(n) for n in names])
        for whole in batches:
            for at in range(0, whole.num_rows, PROBE_ROWS):
                batch = whole.slice(at, PROBE_ROWS)
                parts = [host_and_path(u) for u in batch.column(1).to_pylist()]
                sites = [site_strings(h, p, shapes) for h, p in parts]
                words = [re.findall("[a-z0-9]+", h) for h, _ in parts]
                texts = list(dict.fromkeys([SITE + s for row in sites for s in row] + [WORD + w for row in words for w in row]))
                known = dict(zip(texts, array.probe(texts).tolist()))
                rules = [next((s for s in row if known[SITE + s] >= 0), None) for row in sites]
                blocked = [known[SITE + r] == 1 if r is not None else any(known[WORD + w] == 1 for w in row) for r, row in zip(rules, words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                     pa.array(rules, pa.string()), pa.array([BLOCK if b else ALLOW for b in blocked], pa.string())],
                    ["id", "host", "path", "rule", "verdict"],
                )

    return run


def judged(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", **options) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row of pages under the list."""
    names, shapes = write_list(listed, **options)
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_judge(names, shapes), f"id {kind}, host string, path string, rule string, verdict string")
