"""The Merkle manifest, token-id files and hard negatives against plain versions, on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnfield.llm import merkle, negatives, tokenfiles
from cairnfield.llm.queries import OP11, OP13, op11_merkle_manifest, op12_token_files, op13_hard_negatives, tokenizer_file
from cairnfield.storage import shared_folder
from tests.conftest import DATA, same

draw = random.Random(5)


# --- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Levels of one tree, and the siblings before and after each node's way."""
    ways = [[] for _ in nodes]
    spots = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, s in enumerate(spots):
            run = nodes[s // 16 * 16 : s // 16 * 16 + 16]
            ways[i].append((run[: s % 16], run[s % 16 + 1 :]))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        spots = [s // 16 for s in spots]
    return nodes[0], ways


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: h(*map(enc, r))
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        group = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((group, *climb([leaf(r) for r in group])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (group, sub, ways), top in zip(trees, tops, strict=True):
        for r, way in zip(group, ways, strict=True):
            proof = way + top
            altered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            t = leaf((*r[:4], lower(r[4]))) if altered else leaf(r)
            for a, b in proof:
                t = h(*a, t, *b)
            out.append((r[0], leaf(r), sub, root, h(*[x for a, b in proof for x in (*a, *b)]), t, t == root))
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, rows, more="", **kw):
    df = spark.createDataFrame(rows, MANIFEST + more)
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.manifest(df, F.translate("text", up, up.lower()), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, **kw)


def key(r):
    return tuple((x is not None, x) for x in r)


def test_manifest_of_awkward_rows(spark):
    rows = [(i, draw.choice(["b", "a", None, "", "É"]), draw.choice(["en", None]), draw.choice([None, 7]), draw.choice(["Some TEXT", "lower", "", None, "ÀÉ É", "x" * 50_000])) for i in range(70)]
    rows += [(51, "a", "en", 1, "HIGH"), (None, "a", "en", 1, "NO id"), (None, None, None, None, None), (3, "a", "en", 1, "again"), (3, "a", "en", 1, "again"), (3, "a", "en", 1, "other"), (9, "alone", "en", 2, "ONE")]
    got = [tuple(r) for r in manifest(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain_manifest(rows), key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 4096, 4097, 4113, 9000])
def test_manifest_of_one_source_and_a_small_one(spark, n):
    rows = [(i, "big", "en", i, f"Text {i}") for i in range(n)] + [(10**6 + i, "small", "en", i, f"T {i}") for i in range(3)]
    draw.shuffle(rows)
    got = [tuple(r) for r in manifest(spark, rows).collect()]
    assert sorted(got) == sorted(plain_manifest(rows))


def test_manifest_of_many_sources(spark):
    rows = [(i, f"s{i % 300:03}", "en", i, f"Text {i}") for i in range(700)]
    got = [tuple(r) for r in manifest(spark, rows).collect()]
    assert sorted(got) == sorted(plain_manifest(rows))


def test_manifest_empty_and_clashing_columns(spark):
    assert manifest(spark, []).collect() == []
    more = ", own string, at int, h string, total int, block int, part int, leaf string, row int, altered string, outer string, n int"
    rows = [(i, "a", "en", i, "T") for i in range(20)]
    got = [tuple(r) for r in manifest(spark, [(*r, "x", 1, "y", 2, 3, 4, "z", 5, "q", "o", 6) for r in rows], more).collect()]
    assert sorted(got) == sorted(plain_manifest(rows))


def test_manifest_proofs_fold_to_the_root(spark):
    rows = [(i, "ab"[i % 2], "en", i, f"T {i}") for i in range(50)]
    found = manifest(spark, rows, with_proof=True).withColumn("again", merkle.fold_proof(F.col("leaf"), F.col("proof")))
    assert found.where("again = root").count() == 50
    # a proof is of no use to another leaf
    assert found.withColumn("wrong", merkle.fold_proof(F.sha2(F.lit(b"x"), 256), F.col("proof"))).where("wrong = root").count() == 0


def test_manifest_query_against_sql(spark, duck):
    same(op11_merkle_manifest(spark, f"{DATA}/sf0.001"), duck, OP11)


# --- token-id files

ids_of_any_size = st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**32 - 1), st.sampled_from([(1 << b) - 1 for b in tokenfiles.BITS if b < 33])), max_size=700)


@settings(max_examples=150, deadline=None)
@given(ids_of_any_size, st.integers(1, 9))
def test_words_give_the_ids_back(ids, times):
    ids = np.array(ids * times, np.uint32)
    offsets, words = tokenfiles.encode_blocks(ids)
    assert (tokenfiles.decode_blocks(words, offsets, len(ids)) == ids).all()


def test_words_are_as_the_format_says():
    # one word of 4 ids of 15 bits under selector 12
    offsets, words = tokenfiles.encode_blocks(np.array([5000, 20000, 1, 30000], np.uint32))
    assert words.tolist() == [12 << 60 | 5000 | 20000 << 15 | 1 << 30 | 30000 << 45] and offsets.tolist() == [0, 1, 1]
    # 240 zeros are one word of selector 0
    assert tokenfiles.encode_blocks(np.zeros(240, np.uint32))[1].tolist() == [0]
    # one wide id among narrow ones is an escape: all ones in its word, itself behind
    ids = np.array([3] * 4 + [40000] + [3] * 15, np.uint32)
    offsets, words = tokenfiles.encode_blocks(ids)
    assert offsets.tolist() == [0, 1, 2] and int(words[0]) >> 60 == 4 and int(words[0]) >> 12 & 7 == 7 and int(words[1]) == 40000


def test_ids_between_come_from_their_blocks_alone():
    r = np.random.default_rng(3)
    ids = r.integers(0, 60_000, 3 * tokenfiles.BLOCK + 77).astype(np.uint32)
    content = tokenfiles.segment([1, None], [100, len(ids) - 100], ids, 5) + tokenfiles.MARK.encode()
    (part,) = tokenfiles.segments_of(content)
    assert part[:3] == (0, 5, [1, None]) and part[3].tolist() == [100, len(ids) - 100]
    for a, b in [(0, 1), (1023, 1025), (1024, 2048), (0, len(ids)), (len(ids) - 1, len(ids)), (7, 7)]:
        assert (tokenfiles.ids_between(part, a, b) == ids[a:b]).all()
    # words outside the blocks asked for aren't read
    spoilt = (*part[:6], np.r_[part[6][: part[5][2]], np.zeros(len(part[6]) - part[5][2], np.uint64)])
    assert (tokenfiles.ids_between(spoilt, 10, 1000) == ids[10:1000]).all()
    with pytest.raises(ValueError):
        list(tokenfiles.segments_of(content[:-8] + b"????????"))


def library_rows(rows):
    """rows: (doc_id, text) in the order of the files."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    out, start = [], 0
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def write(spark, rows, schema="doc_id long, text string", parts=3):
    path = f"{shared_folder(spark)}/ids-test-{draw.getrandbits(60)}"
    tokenfiles.write_ids(spark.createDataFrame(rows, schema).repartition(parts), path, tokenizer_file("byte_bpe_50k.json"))
    return path


def test_files_hold_what_the_library_gives(spark):
    words = ["alpha", "Beta", "gamma!", "δέλτα", "🙂", "\n", "<|endoftext|>", "12345"]
    rows = [(i * 3, draw.choice([None, "", " ", " ".join(draw.choices(words, k=draw.randrange(1, 400)))])) for i in range(120)]
    rows += [(7, "word " * 300_000), (None, "no id"), (-5, "before")]
    draw.shuffle(rows)
    path = write(spark, rows)
    want = library_rows(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in tokenfiles.read_ids(spark, path).orderBy("start").collect()]
    assert got == want
    # ascending in each file, and from file to file by name
    files = spark.read.format("binaryFile").load(f"{path}/ids").orderBy("path").collect()
    names = [x for f in files for s in tokenfiles.segments_of(bytes(f["content"])) for x in s[2]]
    assert names == [r[0] for r in want]


def test_files_of_repeated_rows_and_none(spark):
    rows = [(1, "same text")] * 50 + [(1, "other")] * 2 + [(2, "x")]
    found = tokenfiles.read_ids(spark, write(spark, rows), with_ids=False)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted(tuple(r) for r in found.collect())
    sizes = sorted(r[1:3] for r in got)
    assert len(got) == 53 and all(a[0] + a[1] == b[0] for a, b in zip(sizes, sizes[1:], strict=False))
    assert sorted(r[2:] for r in got) == sorted(r[2:4] for r in library_rows(rows))
    assert tokenfiles.read_ids(spark, write(spark, [])).collect() == []


def test_files_ignore_other_columns(spark):
    rows = [(1, "a b", 3, "x", 5), (2, "c", 4, "y", 6)]
    got = tokenfiles.read_ids(spark, write(spark, rows, "doc_id int, text string, ids int, bytes string, part int")).collect()
    assert [(r["doc_id"], r["ids"]) for r in sorted(got)] == [(r[0], r[4]) for r in library_rows([r[:2] for r in rows])]


def test_token_files_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op12_token_files(spark, f"{DATA}/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == [r[:4] for r in library_rows(sorted(docs))]


# --- hard negatives


def plain_negatives(rows, positives=5, negatives=3):
    """rows: (vec_id, label, vector)."""
    real = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))
    anchors = {}
    for r in real:
        if r[0] % 50 == 0 and (r[0] not in anchors or (r[1], r[2]) < (anchors[r[0]][1], anchors[r[0]][2])):
            anchors[r[0]] = r
    out = []
    for a in anchors.values():
        others = sorted((-dot(a[2], r[2]), r[0], r[1]) for r in real if r[0] != a[0] and len(r[2]) == len(a[2]))
        for p in [o for o in others if o[2] == a[1]][:positives]:
            inside = [o for o in others if o[2] != a[1] and 50 * -p[0] <= 100 * -o[0] <= 95 * -p[0]]
            out += [(a[0], p[1], n + 1, o[1], -p[0], -o[0]) for n, o in enumerate(inside[:negatives])]
    return out


VECTORS = "vec_id long, label int, embedding array<float>, more string"


def mined(spark, rows, schema=VECTORS):
    df = spark.createDataFrame([(*r, "x") for r in rows], schema)
    return negatives.hard_negatives(df, F.col("vec_id") % 50 == 0)


def clusters(n, dims=6, labels=4, spread=0.25):
    r = np.random.default_rng(8)
    heart = r.normal(size=(labels, dims))
    return [(i, i % labels, [float(np.float32(x)) for x in heart[(i // 3) % labels] + spread * r.normal(size=dims)]) for i in range(n)]


def test_negatives_of_clusters_ties_and_copies(spark):
    rows = clusters(900)
    rows += [(1000 + i, i % 2, rows[0][2]) for i in range(300)]  # one vector many times
    rows += [(2000, 1, None), (2001, None, rows[1][2]), (2050, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2051, 1, [float("nan")] * 6), (2052, 1, [float("inf")] * 6)]
    rows += [(2100, 3, [0.0] * 6), (2101, 3, [0.0] * 6), (2102, 2, [0.0] * 6), (2150, 1, []), (2151, 1, []), (2152, 0, []), (2200, 0, [1.0, 1.0]), (2201, 0, [1.0, 1.0]), (2202, 1, [0.8, 0.8])]
    got = [tuple(r) for r in mined(spark, rows).collect()]
    assert sorted(got) == sorted(plain_negatives(rows)) and len(got) > 100


def test_negatives_of_repeated_ids_and_few_rows(spark):
    rows = [(50, 1, [1.0, 0.5]), (50, 0, [0.5, 1.0]), (7, 0, [1.0, 1.0]), (7, 0, [1.0, 1.0]), (8, 1, [0.6, 0.6]), (8, 1, [0.6, 0.6]), (9, 1, [0.9, 0.4]), (None, 1, [1.0, 1.0])]
    assert sorted(tuple(r) for r in mined(spark, rows).collect()) == sorted(plain_negatives(rows))
    assert mined(spark, []).collect() == []
    assert mined(spark, [(50, 1, [1.0])]).collect() == []


def test_negatives_of_numbers_beyond_doubles(spark):
    draws = random.Random(2)
    rows = [(i * 25, i % 2, [draws.choice([1e14, 3e13, -2e14, 1.5]) + draws.randrange(1000) for _ in range(3)]) for i in range(24)]
    schema = VECTORS.replace("float", "double")
    assert sorted(tuple(r) for r in mined(spark, rows, schema).collect()) == sorted(plain_negatives(rows))


def test_negatives_with_clashing_names(spark):
    rows = clusters(200)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "q") for r in rows], "vec_id long, label int, embedding array<float>, block int, col int, line int, dims int, q string")
    got = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(plain_negatives(rows))


def test_bounds_leave_pairs_out_and_lose_none():
    r = np.random.default_rng(4)
    x = np.floor(256 * (np.repeat(r.normal(size=(8, 16)), 250, 0) + 0.02 * r.normal(size=(2000, 16))))
    anchors, norms = x[::20], np.sqrt((x * x).sum(1))
    tree = negatives.tree_of(anchors)
    assert sorted(i for i, _, _ in tree) == list(range(100)) and sum(p < 0 for _, p, _ in tree) == 1
    found = {}
    limit = {i: float(np.sort(x @ anchors[i])[-5]) for i in range(100)}
    scored = negatives.walk_tree(tree, anchors, x, norms, True, lambda i, low, high: high >= limit[i], lambda i, rows, s: found.update({i: set(rows[s >= limit[i]].tolist())}))
    assert scored < 0.6 * 100 * 2000
    assert found == {i: set(np.flatnonzero(x @ anchors[i] >= limit[i]).tolist()) for i in range(100)}


def test_negatives_query_against_sql(spark, duck):
    same(op13_hard_negatives(spark, f"{DATA}/sf0.001"), duck, OP13)
