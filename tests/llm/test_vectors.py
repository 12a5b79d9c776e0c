import numpy as np
import pytest
from compare import connect, differences

from gridtally.llm import queries, vectors

SF = "/root/testdata/sf0.001"


def by_hand(rows, cosine=0.98):
    good = []
    for i, (_, v, label) in enumerate(rows):
        usable = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, dtype=np.float64) if usable else None)
    n = len(rows)
    link = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(i):
            a, b = good[i], good[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                c = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
                link[i, j] = link[j, i] = c >= cosine
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in np.flatnonzero(link[todo.pop()]):
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], int(link[i].sum()), min(ids) if ids else None))
    return sorted(out, key=repr)


def result(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], f"vec_id long, embedding array<{kind}>, label int, n int, node int")
    found = vectors.near_duplicates(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr)


@pytest.fixture(scope="module")
def crowd():
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 2):
        center = rng.normal(size=24)
        for spread in (0.02, 0.1, 0.15, 0.25):
            rows += [(center + rng.normal(size=24) * spread * 0.9, label) for _ in range(40)]
    rows += [(rng.normal(size=24), int(rng.integers(1, 4))) for _ in range(150)]
    return [(i, np.float32(v).tolist(), label) for i, (v, label) in enumerate(rows)]


def test_groups_equal_brute_force(spark, crowd, monkeypatch):
    assert result(spark, crowd) == by_hand(crowd)


def test_blocks_change_nothing(spark, crowd):
    posted = vectors.post(vectors.distinct_vectors(
        spark.createDataFrame(crowd, "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label"
    ))
    rows = posted.toPandas()
    x = vectors._unit(np.stack(rows.vector.to_numpy()).astype(float))
    pairs = set()
    group = np.zeros(60, dtype=int)
    whole = {(a, b) for i, j in vectors.group_pairs(group, group, group == 1, x[:60], 0.98) for a, b in zip(i, j)}
    own = np.arange(60) % 3
    for low in range(3):
        for high in range(low, 3):
            at = np.flatnonzero((own == low) | (own == high))
            split = np.full(len(at), low != high)
            for i, j in vectors.group_pairs(np.zeros(len(at), dtype=int), own[at], split, x[at], 0.98):
                pairs |= {(min(a, b), max(a, b)) for a, b in zip(at[i], at[j])}
    assert pairs == whole and whole


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [1.0, 0.0, 0.0], 1), (3, [5.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 2), (5, [1.0, 0.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 0.0], 1), (10, [inf, 0.0, 0.0], 1), (11, [nan, 0.0, 0.0], 1),
        (12, [1.0, 0.0], 1), (13, [2.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1), (14, [1.0, 0.19, 0.0], 1), (14, [1.0, 0.19, 0.0], 1),
        (15, [3.0], 1), (16, [4.0], 1), (17, [-4.0], 1), (18, [1e30, 1e-30, 0.0], 1), (0, [0.98, 0.198997, 0.0], 1),
    ]
    assert result(spark, rows) == by_hand(rows)
    assert result(spark, rows, "double") == by_hand(rows)
    assert result(spark, rows[:1]) == [(1, 0, 1)]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(table.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = table.label.to_numpy()
    close = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    found = queries.QUERIES["op7_vectors"](spark, SF).toPandas().set_index("vec_id")
    want = dict(zip(table.vec_id, close.sum(axis=1)))
    assert all(found.n_links[i] <= n for i, n in want.items())
    assert found.n_links.sum() >= 0.999 * close.sum()


def test_query_equals_sql(spark):
    df = queries.QUERIES["op7_vectors"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op7_vectors"]) is None


@pytest.fixture(scope="module")
def packed():
    """Vectors that share buckets without being alike, with a few close pairs and a close group."""
    rng = np.random.default_rng(9)
    center = rng.normal(size=32)
    loose = center + rng.normal(size=(1200, 32)) * 0.6
    near = loose[:150] + rng.normal(size=(150, 32)) * 0.1
    tight = rng.normal(size=32) + rng.normal(size=(150, 32)) * 0.09
    return [(i, np.float32(v).tolist(), 1) for i, v in enumerate(np.concatenate([loose, near, tight]))]


def test_parted_buckets_keep_their_links(spark, packed):
    df = spark.createDataFrame(packed, "vec_id long, embedding array<float>, label int")
    nodes = vectors.staged(vectors.distinct_vectors(df, "vec_id", "embedding", "label"), "test-nodes")
    posted = vectors.staged(vectors.post(nodes), "test-codes")
    ids = {r.node: r.least_id for r in nodes.collect()}
    _, cut = vectors.meetings(posted, 60, 40)
    assert sum(any(r.parted) for r in cut.select("parted").collect()) > 500
    found = {}
    for r in vectors.links(posted, crowded=60, block=40).collect():
        found[ids[r.node]] = found.get(ids[r.node], 0) + r.n
    want = {i: n for i, n, _ in by_hand(packed) if n}
    assert all(found[i] <= want[i] for i in found)  # no pair is counted twice
    assert sum(found.values()) >= 0.99 * sum(want.values()) > 10_000
    whole = {}
    for r in vectors.links(posted).collect():
        whole[ids[r.node]] = whole.get(ids[r.node], 0) + r.n
    assert whole == want


def test_parting_sends_fewer_rows(spark):
    rng = np.random.default_rng(5)
    center = rng.normal(size=32)
    sent, whole = [], []
    for n in (1000, 4000):
        rows = [(i, np.float32(center + rng.normal(size=32) * 0.6).tolist(), 1) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        nodes = vectors.staged(vectors.distinct_vectors(df, "vec_id", "embedding", "label"), "test-nodes")
        posted = vectors.staged(vectors.post(nodes), "test-codes")
        sent.append(vectors.meetings(posted, 64, 16)[0].count())
        whole.append(vectors.meetings(posted, 1 << 40, 16)[0].count())
    # Four times the vectors: 6.1 times the rows with parting, 7.7 times without.
    assert sent[1] / sent[0] < whole[1] / whole[0] and sent[1] < 0.6 * whole[1]


def test_block_count(spark):
    counts = spark.createDataFrame([(2,), (1024,), (1025,), (8192,), (30_000,), (409_600,)], "n long")
    assert [r[0] for r in counts.select(vectors.block_count(counts.n)).collect()] == [1, 1, 2, 8, 8, 100]


def test_no_bucket_is_parted_for_its_size(spark):
    """One vector has links, or not, whatever number of others its bucket holds."""
    rng = np.random.default_rng(7)
    center = rng.normal(size=8)
    x = np.float32(center + rng.normal(size=(20_000, 8)) * 0.5 * np.linalg.norm(center) / np.sqrt(8))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    nodes = vectors.staged(vectors.distinct_vectors(df, "vec_id", "embedding", "label"), "test-nodes")
    posted = vectors.staged(vectors.post(nodes), "test-codes")

    def parted(rows):
        return rows.filter("exists(parted, p -> p)").count()

    assert parted(vectors.meetings(posted, 8192)[1]) > 0  # parting would change this table
    assert parted(vectors.meetings(posted)[1]) == 0
