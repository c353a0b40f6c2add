"""SimHash links against all pairs, dimension versions and the Merkle manifest against plain Python."""

import hashlib
import random
import zlib
from datetime import datetime, timedelta

import pytest
import xxhash
from pyspark.sql import functions as F

from siftwell.llm import dimension, merkle, simhash
from siftwell.llm.queries import op11_simhash_dedup, op12_dimension_merge, op13_merkle_manifest


def plain_print(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows of (doc_id, text) -> {(doc_id, fingerprint, component)} by all pairs."""
    prints = [plain_print(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same_id or (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), f"{p:016x}", str(least.get(root(i)))) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def joined(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, print string, `a.b` int")
    return sorted((str(r[0]), r[1], str(r[2])) for r in simhash.join(docs).collect())


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c", "A  b\nc\x0bd É", "x " * 300, "  nbsp is a word", "é" * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_fingerprint_of_long_texts(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["word ", "Wörter\n", "x", "  ", "a b "]) for _ in range(5000))
    want = plain_print(text)
    for part in (1, 7, 1000):
        monkeypatch.setattr(simhash, "PART", part)
        assert simhash.fingerprint(text) == want


def test_simhash_odd_rows(spark):
    rng = random.Random(2)
    base = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(200)]
    rows = [(9, None), (4, ""), (7, "one two three"), (7, "something else entirely here"), (None, "one two three"), (None, "alone, without an id"), (3, "something else entirely here"), (12, " ".join(base))]
    for k in range(60):
        words = list(base)
        words[rng.randrange(200)] = "changed"
        rows.append((100 + k % 50, " ".join(words)))
    rows += [(5, None)] * 3
    assert joined(spark, rows) == plain_components(rows)
    assert joined(spark, []) == []


def test_simhash_large_buckets(spark, monkeypatch):
    """Buckets are split again, several times over, and no link is lost."""
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1} | {rng.getrandbits(64) for _ in range(100)}
    for centre in list(prints)[:6]:
        for _ in range(150):
            p = centre
            for _ in range(rng.randint(1, 5)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "TILE", 8)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    got = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(rows).collect()]

    def groups(edges):
        up = {p: p for p in prints}

        def root(p):
            while up[p] != p:
                p = up[p]
            return p

        for a, b in edges:
            up[root(a)] = root(b)
        out = {}
        for p in prints:
            out.setdefault(root(p), []).append(p)
        return sorted(map(tuple, out.values()))

    assert groups(got) == groups([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3])


def test_simhash_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = sorted((str(r[0]), r[1], str(r[2])) for r in op11_simhash_dedup(spark, "/root/testdata/sf0.001").collect())
    assert got == plain_components([tuple(r) for r in docs])


SCHEMA = "client_id long, change_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, extra string, `a.b` int"
FIELDS = ("source", "segment", "city", "cents")


def plain_versions(rows):
    """The contract, one client and one change at a time."""
    start, out = datetime(1970, 1, 1), []
    moved = {}
    for client, change, seq, op, at, source, segment, city, balance, *_ in rows:
        if at is not None:
            t = int((at - start).total_seconds()) - (720 * 3600 if change is not None and zlib.crc32(str(change).encode()) % 5 == 0 else 0)
            cents = None if balance is None else int((100 * balance + 0.5) // 1)
            moved.setdefault(client, set()).add((seq, change, t, op, (source, segment, city, cents)))
    least = lambda x: (x is not None, x or 0)
    for client, changes in moved.items():
        by_seq, by_time = {}, {}
        for r in sorted(changes, key=lambda r: (least(r[1]), r[2])):
            by_seq[r[0]] = r
        for r in sorted(by_seq.values(), key=lambda r: (least(r[0]), least(r[1]))):
            by_time[r[2]] = r
        state, found = None, []
        for t, (seq, _, _, op, values) in sorted(by_time.items()):
            if op not in ("D", "I", "U"):
                continue
            if op == "D":
                new = (True, None, None, None, None)
            elif op == "I" or state is None:
                new = (False, *values)
            else:
                new = (False, *[b if v is None else v for v, b in zip(values, state[1:])])
            if new != state:
                found.append((t, seq, new))
            state = new
        for k, (t, seq, now) in enumerate(found):
            until = found[k + 1][0] if k + 1 < len(found) else None
            n = len({c for _, c, u, *_ in changes if c is not None and u >= t and (until is None or u < until)})
            out.append((client, k + 1, t, until, *now, seq, n))
    return sorted(out, key=repr)


def versions(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/client_changes.parquet")
    return sorted((tuple(r) for r in op12_dimension_merge(spark, str(tmp_path)).collect()), key=repr)


def random_changes(rng, n, clients):
    day = datetime(2024, 1, 1)
    pick = lambda *x: rng.choice([None, *x])
    return [
        (rng.choice(clients), pick(*range(n)), rng.choice([None, *range(n // 4)]), rng.choice("DIUUUUX"), pick(*[day + timedelta(hours=rng.randrange(900)) for _ in range(20)]), pick("a", "b"), pick("s"), pick("x", "y", "z"), pick(1.005, -2.5, 0.0), "e", 1)
        for _ in range(n)
    ]


@pytest.mark.parametrize("clients", [[1, 2, 3, None], [1] * 30 + [2, 3, None], [1]])
def test_dimension_versions(spark, tmp_path, clients):
    rows = random_changes(random.Random(len(clients)), 400, clients)
    rows += rows[:40]
    assert versions(spark, rows, tmp_path) == plain_versions(rows)


def test_dimension_of_one_client_is_cut(spark, tmp_path, monkeypatch):
    """A client with most rows runs in many pieces; deletions, gaps and versions go across the cuts."""
    monkeypatch.setattr(dimension, "FINE", 200)
    rng = random.Random(5)
    day = datetime(2024, 1, 1)
    rows = [(1, k, k, rng.choice("UUUUUUUUDI" if k % 100 < 20 else "U"), day + timedelta(minutes=37 * k), rng.choice([None, None, "a"]), None, rng.choice([None, None, None, "x", "y"]), None, "e", 1) for k in range(600)]
    rows += [(2, 1000 + k, k, "U", day + timedelta(hours=k), "a", "b", "c", float(k % 3), "e", 1) for k in range(5)]
    pieces = dimension._cuts(spark.createDataFrame([(r[0], int(r[4].timestamp())) for r in rows], "e long, t long"), 4).collect()
    assert [p.e for p in pieces] == [1] and len(pieces[0].cuts) > 50
    assert versions(spark, rows, tmp_path) == plain_versions(rows)


def test_dimension_of_nothing(spark, tmp_path):
    assert versions(spark, [], tmp_path) == []
    assert versions(spark, [(1, 1, 1, "U", None, "a", "b", "c", 1.0, "e", 1)], tmp_path) == []


def test_time_without_zone_is_utc(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:15.250' as `t.t`, timestamp_ntz'1969-12-31 23:59:59' as u")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert tuple(df.select(dimension.micros(df, "t.t"), dimension.micros(df, "u")).first()) == (1711852215250000, -1000000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """(root, siblings of each leaf, level by level) of an ordered list."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, p in enumerate(at):
            run = runs[p // 3]
            paths[k].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
        at, level = [p // 3 for p in at], [sha(*run) for run in runs]
    return level[0], paths


def plain_leaf(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_manifest(rows):
    groups = {}
    for doc_id, source, lang, n_chars, text, *_ in rows:
        harmed = text.replace("\n", "") if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text
        groups.setdefault(source, []).append((doc_id, plain_leaf(doc_id, source, lang, n_chars, text), plain_leaf(doc_id, source, lang, n_chars, harmed)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [plain_tree([leaf for _, leaf, _ in groups[s]]) for s in names]
    root, over = plain_tree([top for top, _ in trees]) if names else (None, [])
    out = []
    for s, (top, paths), above in zip(names, trees, over):
        for (doc_id, leaf, claimed), path in zip(groups[s], paths):
            path, folded = path + above, claimed
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((doc_id, leaf, top, root, sha(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=repr)


def manifest(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, digest string, `a.b` int, `group` int").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_merkle_manifest(spark, tmp_path, monkeypatch, depth):
    """Groups of one to many blocks, and blocks of blocks."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rng = random.Random(depth)
    sizes = [(None, 4), ("", 1), ("hot", 90), ("é", 27), ("z", 28), ("~", 3), ("\U0001f600", 2), ("￮", 10)]
    rows = [(rng.randrange(10**6), s, rng.choice(["en", None]), rng.choice([None, 5]), rng.choice([None, "", "a\nb", "plain é\n\nx"]), "d", 1, 2) for s, n in sizes for _ in range(n)]
    rows += rows[:3] + [(None, "hot", "en", 1, "no id\n", "d", 1, 2), (rows[20][0], "hot", None, None, "same id, other text", "d", 1, 2)]
    assert manifest(spark, rows, tmp_path) == plain_manifest(rows)


def test_merkle_of_nothing_and_of_one(spark, tmp_path):
    assert manifest(spark, [], tmp_path) == []
    one = [(2, "s", "en", 3, "a\nb", "d", 1, 2)]
    got = manifest(spark, one, tmp_path)
    assert got == plain_manifest(one) and got[0][1] == got[0][3] and got[0][4] == hashlib.sha256(b"").hexdigest()


def test_merkle_paths_lead_to_the_root(spark):
    docs = spark.range(100).select("id", F.lit("s").alias("s"))
    for r in merkle.proofs(docs, "s", "id", merkle.leaf(F.col("id"))).collect():
        h = r.leaf
        for left, right in r.path:
            h = sha(left, h, right)
        assert h == r.root == r.folded_root and r.verified
