"""Secret scan and syncmer fingerprints against plain Python restatements."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from isobar.llm import secrets, syncmers

SMALL = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
ODD = [
    None, "", " ", "x", "token=secret: token: abcdefgh", "PASSWORD = 'abc'", "api-key", "apikey:\"Zz9+/=.-_x\"",
    "AKIA" + "A1" * 8, "AKIA" + "B" * 15, "xAKIAAKIA" + "Z" * 20, "f" * 23 + " " + "e" * 24 + "G", "é" * 3 + "0a" * 20 + "ü",
    "key Zx81kQpW02mNvB7tRy6LdS3 end", "thequickbrownfoxjumpsoverthelazydog", "a-b-c-d-e-f-g-h-i-j-k-l-m", "1234567890" * 4,
    "Zk3//9sJq0Lw7+Xp2RtYv5BnM8 /Zk39sJq0Lw7+Xp2RtYv5BnM8 //Zk39sJq0Lw7+Xp2RtYv5BnM8", "deadbeef" * 4 + "Zx81kQpW02mNvB7tRy6LdS3Hq",
    "Zx81kQpW02mNvB7tRy6LdS3Hq" + "deadbeef" * 4, "a0000Zx81kQpW02mNvB7tRy6example", "exampleKeyPlaceholder12345678", "/usr/lib/python3/site-packages",
    "getElementByIdAndClassName2", "https://host/path/to/some/file_name_2024", "token=abcdefZx81kQpW02mNvB7tRy6LdS3Hq" + "/" * 3, "x" * 40,
    "Zx81kQpW02mNvB7tRy6L" + "0123456789abcdef" * 2 + "Zx81kQpW02mNvB7tRy6L", "0000-0000-1234567-00000-11", "aB" * 30, "00000000000000000000x",
    "😀 token: \t x token:  'aaaaaa' " + "q9" * 30, "Zx81kQpW02mNvB7tRy6LdS3 " * 3,
]


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(spans)


def entropy(run, window):
    best = 0.0
    for i in range(len(run) - window + 1):
        part = run[i:i + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def harmless(run):
    """All of a run is words, numbers and placeholders."""
    parts = re.split(secrets.SEPARATOR, run)
    word = r"([A-Z]?[a-z]*|[A-Z]+)[0-9]{0,4}|[xX]+|0+|0?123456789?0?|12345678?"
    plain = all(re.fullmatch(word, p, re.A) for p in parts)
    return bool(re.fullmatch("[0-9+/_=-]+", run)) or (plain and len(run) >= 3 * len(parts))


def everything(text):
    spans = base(text)
    found = list(spans)
    for m in re.finditer(secrets.CANDIDATE, text or ""):
        free = [i for i in range(*m.span()) if not any(x <= i < y for x, _, y in spans)]
        cuts = [k for k in range(len(free)) if not k or free[k] != free[k - 1] + 1]
        for j, k in enumerate(cuts):
            part = free[k:cuts[j + 1] if j + 1 < len(cuts) else None]
            a, b = part[0], part[-1] + 1
            run = text[a:b]
            if b - a < secrets.WINDOW or harmless(run):
                continue
            least = next(v for _, p, v in secrets.CLASSES if re.search(p, run))
            if entropy(run, secrets.WINDOW) >= least - 1e-9:
                found.append((a, 3, b))
    return sorted(found)


def write(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def texts(spark):
    known = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    return list(enumerate(ODD + known + ODD[:6]))


def test_secrets_equal_brute_force(spark, texts):
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("base", F.lit(1))
    got = {r.doc_id: r for r in secrets.find(rows).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        spans, r = base(text), got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3)), text
        assert r.base_sha256 == hashlib.sha256(write(spans).encode()).hexdigest()
        assert r.spans == write(everything(text)), text
    assert any("entropy" in r.spans for r in got.values())


def test_secrets_plan_is_native(spark, texts):
    plan = secrets.find(spark.createDataFrame(texts[:3], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_keys_beside_harmless_parts_are_found(spark):
    rows = [(1, "Zk3//9sJq0Lw7Xp2RtYv5BnM8"), (2, "/Zk39sJq0Lw7Xp2RtYv5BnM8"), (3, "deadbeef" * 4 + "Zx81kQpW02mNvB7tRy6LdS3Hq"),
            (4, "0000Zk39sJq0Lw7Xp2RtYv5BnM81234567example"), (5, "ZkqsJqwLwtXptRtYvnBnMwqGhLpTw9Rk")]
    got = {r.doc_id: r.spans for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("entropy" in spans for spans in got.values()), got
    assert got[3] == "hex:0:32,entropy:32:57"


def test_long_runs_take_seconds(spark):
    """Two hundred thousand signs in one run: the last ones decide."""
    import random
    import time

    calm, key = "xy1" * 66_000, "".join(random.Random(1).choices("ABCDEFGHKLMNPQRSTUVWXYZabcdefghkmnpqrstuvwxyz23456789", k=2000))
    rows = spark.createDataFrame([(1, calm), (2, calm + key)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r.spans for r in secrets.find(rows).collect()}
    assert got == {1: "", 2: f"entropy:0:{len(calm) + len(key)}"} and time.time() - start < 90


def test_secrets_empty_table(spark):
    assert secrets.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def edited(rows):
    """Expected next and edited texts by ascending id (nulls first), ties by text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((i, t, following, t[:len(t) - half] + following[:half]))
    return out


@pytest.mark.parametrize("block_rows", [3, 50, 100_000])
def test_edited_texts_over_block_borders(spark, texts, block_rows):
    rows = [(i * 7 - 300, t) for i, t in texts] + [(5_000, "a b"), (5_000, "a a"), (None, "null id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = syncmers.edited_fingerprints(df, block_rows=block_rows).collect()
    want = sorted((-1 if i is None else i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, _, e in edited(rows))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


def test_only_null_ids_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert syncmers.edited_fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = syncmers.edited_fingerprints(spark.createDataFrame([(None, "a b")], schema)).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(0.0, 1.0)] or one[0].near_next == 1.0


MASK = (1 << 32) - 1


def xxh(value, seed=42):
    """Spark's xxhash64 of a string or a bigint."""
    import struct

    import xxhash

    data = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    h = xxhash.xxh64_intdigest(data, seed % (1 << 64))
    return h - (1 << 64) if h >= 1 << 63 else h


def murmur(values, seed=42):
    """Spark's 32-bit hash of a row of bigints, as an unsigned number."""
    turn = lambda x, r: (x << r | x >> 32 - r) & MASK
    for v in values:
        for half in (v & MASK, v >> 32 & MASK):
            seed ^= turn(half * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
            seed = (turn(seed, 13) * 5 + 0xE6546B64) & MASK
        seed ^= 8
        seed = (seed ^ seed >> 16) * 0x85EBCA6B & MASK
        seed = (seed ^ seed >> 13) * 0xC2B2AE35 & MASK
        seed ^= seed >> 16
    return seed


def closed_syncmers(tokens, k, s):
    hashed = [xxh(t) for t in tokens]
    if len(hashed) < k:
        return [murmur(hashed)] if hashed else []
    runs = []
    for i in range(len(hashed) - s + 1):
        h = 42
        for v in hashed[i:i + s]:
            h = xxh(v, h)
        runs.append(h)
    inner = k - s + 1
    return [murmur(hashed[i:i + k]) for i in range(len(hashed) - k + 1) if min(runs[i:i + inner]) in (runs[i], runs[i + inner - 1])]


def anchors(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    body = "" if not words else text if len(text) < syncmers.SHORT else " ".join(w for w in words if len(w) >= syncmers.LONG_WORD)
    return closed_syncmers(words, syncmers.K, syncmers.S) + closed_syncmers(body, syncmers.SIGNS_K, syncmers.SIGNS_S)


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_and_likeness_equal_brute_force(spark, texts):
    own = texts[:len(ODD)] + [t for t in texts[len(ODD):-6] if len(t[1] or "") < 5000][:60]
    own += [(9000, "x" * 30 + "日本語" * 400), (9001, "word " * 200 + "Z9" * 50), (9002, " \n ")]
    df = spark.createDataFrame(own, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("body", "own", "block", "guest", "next_body")})
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(df).collect()}
    assert len(got) == len(own)
    for i, text, following, changed in edited(own):
        a, b, c = anchors(text), anchors(changed), anchors(following)
        assert got[i].fingerprint == "".join(f"{x:08x}" for x in a), text[:80]
        assert got[i].edited_fingerprint == "".join(f"{x:08x}" for x in b), text[:80]
        assert got[i].near_edited == pytest.approx(alike(a, b)) and got[i].near_next == pytest.approx(alike(a, c))


def test_half_of_a_short_or_unspaced_text_is_seen(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "日本語の文章はここにあります。" * 4), (3, "unrelated words stand in this row"), (4, "Qq" * 30), (5, "one two three four five six seven")]
    got = syncmers.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.near_edited > r.near_next for r in got), got


def test_very_long_texts(spark):
    text = " ".join(f"w{i % 1000}" for i in range(300_000))
    rows = spark.createDataFrame([(1, text), (2, text[:-1] + "!")], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(rows).collect()}
    assert got[1].n_chars == len(text) and got[1].near_next > 0.99 and got[1].fingerprint[:-8] != ""


def test_anchors_are_context_free(spark):
    words = [f"w{(i * i) % 37}" for i in range(400)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:200])), (3, "a b"), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.a for r in syncmers.with_anchors(rows, "text", "a").collect()}
    assert len(got[3]) == 2 and got[4] == []
    assert got[1][:len(got[2])] == got[2]  # a prefix keeps its anchors


def test_fingerprints_of_equal_and_near_texts(spark):
    words = " ".join(f"word{i}" for i in range(400))
    near = words.replace("word200 ", "other ")
    rows = spark.createDataFrame([(1, words), (2, words), (3, near), (4, " ".join(f"x{i}" for i in range(400)))], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(rows).collect()}
    assert got[1].fingerprint == got[2].fingerprint and got[1].near_next == 1.0
    assert 0.9 < got[2].near_next < 1 and got[3].near_next == 0.0
