"""URL filters: a sorted digest array, memory-mapped and probed by binary search.

A rule (host, path, verdict) fits its host and all subdomains of it where the url's
path starts with the rule's path; the longest fitting rule wins. Rules become one
file: 64-bit xxhash digests in ascending order, the offsets of the full strings, the
verdicts and the strings. Spark ships the file to the executors; each worker maps it,
so a page of it is read only where a probe lands. The keys a url can match are its
host's label suffixes with its path's prefixes of the lengths that rules have. All of
a batch's keys are probed at once, and a hit counts only if the stored string is the
key: two strings of one digest lie side by side and are both compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import scratch

#: A rule file may not be larger: it goes to every executor's disk.
MOST_BYTES = 1 << 30

#: Fixed rules of the query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

HEAD = np.dtype([("keys", "<i8"), ("bytes", "<i8"), ("lengths", "<i8")])


def digest(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def build(rules: list[tuple[str, str, str]]) -> bytes:
    """The rules' file. A rule given twice must not contradict itself."""
    verdicts: dict[bytes, bytes] = {}
    for host, start, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"not a verdict: {verdict}")
        key = f"{host.lower()}{start}".encode()
        if verdicts.setdefault(key, verdict[:1].encode()) != verdict[:1].encode():
            raise ValueError(f"two verdicts for {key.decode()}")
    if sum(map(len, verdicts)) + 17 * len(verdicts) > MOST_BYTES:
        raise ValueError(f"the rules take more than {MOST_BYTES} bytes")
    keys = list(verdicts)
    digests = digest(keys)
    order = sorted(range(len(keys)), key=lambda i: (digests[i], keys[i]))
    keys = [keys[i] for i in order]
    ends = np.cumsum([0, *map(len, keys)], dtype=np.int64)
    lengths = np.array(sorted({len(start.encode()) for _, start, _ in rules}), dtype=np.int64)
    head = np.array([(len(keys), ends[-1], len(lengths))], dtype=HEAD)
    parts = [x.tobytes() for x in (head, digests[order].astype("<u8"), ends, lengths)]
    return b"".join([*parts, *[verdicts[k] for k in keys], *keys])


class Rules:
    """A rule file, mapped and not read."""

    def __init__(self, path: str):
        n, size, lengths = np.fromfile(path, HEAD, 1)[0].tolist()
        at = HEAD.itemsize

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind)
            at += got.nbytes
            return got

        self.digests, self.ends = part("<u8", n), part("<i8", n + 1)
        self.lengths = part("<i8", lengths).tolist()
        self.verdicts, self.strings = part("S1", n), part("u1", size)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of each key's rule, -1 for none."""
        wanted, found = digest(keys), np.full(len(keys), -1, dtype=np.int64)
        at = np.searchsorted(self.digests, wanted)
        while True:
            live = np.flatnonzero((found < 0) & (at < len(self.digests)))
            live = live[self.digests[at[live]] == wanted[live]]
            if not len(live):
                return found
            for i in live.tolist():
                if self.string(at[i]) == keys[i]:
                    found[i] = at[i]
            at[live] += 1

    def string(self, i: int) -> bytes:
        return self.strings[self.ends[i] : self.ends[i + 1]].tobytes()

    def verdict(self, i: int) -> str:
        return "allow" if self.verdicts[i] == b"a" else "block"


def judge(urls: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule (null: none fits) and verdict, which is ``default``
    where no rule fits. ``urls`` must hold a column url; columns of the added names
    are replaced.

    A null url, or one without ``://``, has an empty host and path, which no rule
    fits. Rows are judged one by one: repeated rows repeat, no rows give none. Two
    rules of equal length that fit the same url are told apart by the longer host.
    """
    spark = urls.sparkSession
    path = scratch(spark, "url-rules")
    name = path.rpartition("/")[2]
    _write(spark, path, build(rules))
    spark.sparkContext.addFile(path)
    out = urls.drop("host", "path", "rule", "verdict")
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", 1)
    out = out.withColumns(
        {
            "host": F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            "path": F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", 2),
        }
    )

    @F.pandas_udf("rule string, verdict string")
    def ruled(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        table, keys, owners, ranks = _mapped(name), [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            host, path, start = host.encode(), path.encode(), 0
            while host:
                suffix = host[start:]
                for n in table.lengths:
                    if n <= len(path):
                        keys.append(suffix + path[:n])
                        owners.append(i)
                        ranks.append((len(suffix) + n, len(suffix)))
                dot = host.find(b".", start)
                if dot < 0:
                    break
                start = dot + 1
        found = table.find(keys)
        best: dict[int, tuple] = {}
        for k in np.flatnonzero(found >= 0).tolist():
            best[owners[k]] = max(best.get(owners[k], ((0, 0), -1)), (ranks[k], int(found[k])))
        rule, verdict = [None] * len(hosts), [default] * len(hosts)
        for i, (_, k) in best.items():
            rule[i], verdict[i] = table.string(k).decode(), table.verdict(k)
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    return out.withColumn("__r", ruled("host", "path")).select(
        *out.columns, F.col("__r.rule").alias("rule"), F.col("__r.verdict").alias("verdict")
    )


def _write(spark: SparkSession, path: str, content: bytes) -> None:
    """A file in the shared folder, in whatever file system that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    for at in range(0, len(content), 1 << 20):
        out.write(bytearray(content[at : at + (1 << 20)]))
    out.close()


_open: dict[str, Rules] = {}


def _mapped(name: str) -> Rules:
    if name not in _open:
        _open[name] = Rules(SparkFiles.get(name))
    return _open[name]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES).drop("url")


_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, lower(regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 1)) AS host,
         regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path FROM cut
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {"op6_url_filter": _SQL}
