"""Personal data: base patterns, and bootstrapped contextual extraction on top of them.

Every base match is a seed.  The two words before an identifier-like token form its lexical
pattern.  Spark scores the graph between patterns and values: a pattern is as good as the share of
its values that are known for a kind, a value is as good as its patterns together (noisy or), a
few rounds over.  Patterns of high confidence and enough distinct seeds then mark tokens in their
place that no base pattern matches."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table, release, save

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: a pattern needs so many distinct seed values of a kind, and this share of its values
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.75
#: digits of a token that may be discovered
MIN_DIGITS = 5

# The stated base patterns; look-behinds and possessive repeats only keep the search linear.
EMAIL = regex.compile(r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*")
EDGE = re.compile(r"^[^0-9A-Za-z]+|[^0-9A-Za-z]+$")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches, by start and then by kind."""
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = "".join(DIGIT.findall(m.group()))
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m.group())) <= 15]
    return sorted(out)


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def context(text: str, start: int) -> str:
    """The two words before ``start``, lower-cased, without outer punctuation."""
    lo = max(0, start - 80)
    left = text[lo:start].split()
    if lo > 0 and left and not text[lo - 1].isspace():
        left = left[1:]
    return " ".join(EDGE.sub("", w.lower()) for w in left[-2:])


def edges(text: str, spans) -> list[dict]:
    """Pattern, value and span of every base match (``kind`` set) and identifier-like token (null)."""
    out = [{"start": a, "end": b, "kind": k, "pattern": context(text, a), "value": text[a:b]} for a, k, b in spans]
    if DIGIT.search(text):
        for m in TOKEN.finditer(text):
            core = EDGE.sub("", m.group())
            a = m.start() + m.group().find(core)
            b = a + len(core)
            if len(DIGIT.findall(core)) >= MIN_DIGITS and not any(x < b and a < y for x, _, y in spans):
                out.append({"start": a, "end": b, "kind": None, "pattern": context(text, a), "value": core})
    return out


EDGE_TYPE = "struct<start:int,end:int,kind:int,pattern:string,value:string>"


def scan(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): rid (a number of its own), base counts, digest, spans and graph edges."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()),
                               ("pattern", pa.string()), ("value", pa.string())]))

    def run(batches):
        for b in batches:
            counts, sha, base, found = [[], [], [], []], [], [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                s = base_spans(t)
                for k in range(4):
                    counts[k].append(sum(1 for x in s if x[1] == k))
                sha.append(hashlib.sha256(spans_text(s).encode()).hexdigest())
                base.append([{"start": a, "kind": k, "end": e} for a, k, e in s])
                found.append(edges(t, s))
            spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()),
                 pa.array(base, spans), pa.array(found, kind)],
                names=["doc_id", "rid", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "edges"])

    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid")).mapInArrow(
        run, "doc_id long, rid long, " + ", ".join(f"n_{k} long" for k in KINDS)
        + f", base_sha256 string, base array<struct<start:int,kind:int,end:int>>, edges array<{EDGE_TYPE}>")


def score_patterns(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) of the trusted patterns, from (pattern, value, kind) links with a
    null kind where the value is only identifier-like.  All sums are pre-aggregated by key."""
    pairs = save(links.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-pairs")
    width = pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("width"))
    seeds = pairs.where("kind is not null").groupBy("value", "kind").agg(F.lit(1.0).alias("conf"))
    known = save(seeds, "pii-known")
    good = None
    for _ in range(rounds):
        votes = (pairs.select("pattern", "value", F.col("kind").alias("seed")).join(known, "value")
                 .groupBy("pattern", "kind").agg(F.sum("conf").alias("mass"), F.count("seed").alias("seeds")))
        good = save(votes.where(F.col("seeds") >= MIN_SEEDS).join(width, "pattern")
                    .select("pattern", "kind", (F.col("mass") / (F.col("width") + 1)).alias("confidence"))
                    .where(F.col("confidence") >= MIN_CONFIDENCE), "pii-good")
        more = (pairs.where("kind is null").select("pattern", "value").join(good, "pattern")
                .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("conf")))
        known = save(seeds.unionByName(more).groupBy("value", "kind").agg(F.max("conf").alias("conf")), "pii-known")
    return good


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): n_email, n_ip, n_card, n_phone and base_sha256 of the base matches,
    ``spans`` with the discovered ones too, and n_found, the number of these.

    A null text counts as empty: no spans, the digest of the empty string.  Repeated rows are
    treated each on their own; an empty table gives an empty result."""
    rows = save(scan(docs), "pii-rows")
    flat = rows.select("rid", F.explode("edges").alias("e")).select("rid", "e.*")
    good = score_patterns(flat.where("pattern <> ''").select("pattern", "value", "kind"))
    found = (flat.where("kind is null").drop("kind").join(good, "pattern")
             .groupBy("rid", "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
             .groupBy("rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")))   # of one text
    every = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return rows.join(found, "rid", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.concat_ws(",", F.transform(every, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).alias("n_found"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
