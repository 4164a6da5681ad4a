import pytest
import xxhash
from corpus_texts import docs_of, sentence  # noqa: F401
from pyspark.sql import functions as F
from starforge.llm import mixing


def divided(budget, children):
    """``budget`` among (weight, capacity) children, step by step."""
    out = [0.0] * len(children)
    open_ = [i for i, (w, c) in enumerate(children) if w > 0 and c > 0]
    while open_ and budget > 0:
        unit = budget / sum(children[i][0] for i in open_)
        full = [i for i in open_ if children[i][1] <= children[i][0] * unit]
        for i in full or open_:
            out[i] = children[i][1] if full else children[i][0] * unit
        if not full:
            break
        budget -= sum(children[i][1] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def budgets(tokens, mix):
    """Tokens of each leaf (a tuple), by walking down the tree."""

    def capacity(path, depth):
        if depth == len(mix.levels):
            return tokens[path] * mix.epochs
        return sum(capacity(c, depth + 1) for c in below(path, depth) if mix.weights[depth].get(c[-1], 1.0) > 0)

    def below(path, depth):
        return sorted({leaf[: depth + 1] for leaf in tokens if leaf[:depth] == path})

    out = {}

    def hand_down(path, depth, budget):
        if depth == len(mix.levels):
            out[path] = int(budget + 1e-6)
            return
        children = below(path, depth)
        parts = divided(budget, [(mix.weights[depth].get(c[-1], 1.0), capacity(c, depth + 1)) for c in children])
        for c, part in zip(children, parts):
            hand_down(c, depth + 1, part)

    hand_down((), 0, min(mix.share * sum(tokens.values()), capacity((), 0)))
    return out


def spark_budgets(spark, tokens, mix):
    rows = [(*leaf, n) for leaf, n in tokens.items()]
    names = [f"_l{k}" for k in range(len(mix.levels))]
    leaves = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names) + ", n long")
    return {tuple(r[:-2]): r["budget"] for r in mixing.budgets(leaves, names, mix).collect()}


def test_shortage_goes_to_siblings_first(spark):
    assert divided(100, [(1, 10), (1, 1000), (2, 1000)]) == [10, 30, 60]
    assert divided(100, [(1, 10), (0, 1000), (1, 20)]) == [10, 0, 20]
    mix = mixing.Mix(["d", "l"], [{"a": 0.5, "b": 0.5}, {}], share=0.5, epochs=1)
    tokens = {("a", "x"): 10, ("a", "y"): 500, ("b", "x"): 40, ("b", "y"): 450}
    want = {("a", "x"): 10, ("a", "y"): 240, ("b", "x"): 40, ("b", "y"): 210}
    assert budgets(tokens, mix) == want == spark_budgets(spark, tokens, mix)
    # all of a's leaves are full, so what is left goes up and to b
    tokens = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 400, ("b", "y"): 570}
    got = spark_budgets(spark, tokens, mix)
    assert got == budgets(tokens, mix)
    assert got[("a", "x")] == 10 and got[("a", "y")] == 20 and got[("b", "x")] + got[("b", "y")] == 470


@pytest.mark.parametrize("seed, share, epochs", [(1, 0.6, 4), (2, 2.5, 3), (3, 9.0, 2)])
def test_budgets_by_a_walk_of_the_tree(spark, seed, share, epochs):
    import random

    rng = random.Random(seed)
    tokens = {(f"d{rng.randrange(4)}", f"l{rng.randrange(3)}", f"s{k}"): rng.choice([0, 1, 30, 5000, 90_000]) for k in range(60)}
    weights = [{"d0": 0.5, "d1": 0.2, "d2": 0.0}, {"l0": 3.0, "l1": 0.25}, {"s1": 0.0, "s2": 10.0}]
    mix = mixing.Mix(["a", "b", "c"], weights, share=share, epochs=epochs)
    assert spark_budgets(spark, tokens, mix) == budgets(tokens, mix)


def spark_hash(*values):
    """Spark's xxhash64 of the values, one after the other."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v.to_bytes(4 if isinstance(v, bool) else 8, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def mixed(docs, **k):
    mix = mixing.Mix(["lang", "source"], [{"en": 2.0, "de": 1.0}, {}], **{"share": 0.5, "epochs": 3, **k})
    return mixing.mixed(docs, mix)


@pytest.fixture
def docs(docs_of):
    pairs = [(i, sentence(i, 1 + i * 13 % 40)) for i in range(300)]
    lang = F.when(F.col("doc_id") < 20, "de").when(F.col("doc_id") < 200, "en")
    return docs_of(pairs).withColumn("lang", lang).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3)).drop("n_tokens")


def test_budgets_are_met_and_prefixes_exact(docs):
    rows = mixed(docs).collect()
    total = sum(r["n_tokens"] for r in rows)
    assert len(rows) == 300 and all(r["n_tokens"] == len(r["text"].split()) for r in rows)
    tokens, taken, partly = {}, {}, {}
    for r in rows:
        leaf = (r["lang"] or "\x00", r["source"])
        tokens[leaf] = tokens.get(leaf, 0) + r["n_tokens"]
        taken[leaf] = taken.get(leaf, 0) + r["tokens_taken"]
        over = r["tokens_taken"] - r["epochs"] * r["n_tokens"]
        assert 0 <= over <= r["n_tokens"]
        partly[leaf] = partly.get(leaf, 0) + (0 < over < r["n_tokens"])
    want = budgets(tokens, mixing.Mix(["lang", "source"], [{"en": 2.0, "de": 1.0}, {}], share=0.5, epochs=3))
    assert taken == want and max(partly.values()) <= 1
    assert sum(taken.values()) == pytest.approx(total / 2, abs=len(tokens))
    de = {leaf: n for leaf, n in taken.items() if leaf[0] == "de"}
    assert sum(de.values()) <= 3 * sum(n for leaf, n in tokens.items() if leaf[0] == "de")


def test_same_seed_same_choice_other_seed_other(docs):
    def chosen(seed):
        return {r["doc_id"] for r in mixed(docs, share=0.3, seed=seed).collect() if r["tokens_taken"]}

    assert chosen(1) == chosen(1) != chosen(2)


def test_odd_rows(docs_of):
    pairs = [(1, "a b c")] * 7 + [(2, None), (3, ""), (None, "x y"), (4, sentence(1, 20_000))]
    rows = mixed(docs_of(pairs), epochs=1).collect()
    assert len(rows) == 11
    assert {(r["doc_id"], r["n_tokens"]) for r in rows} == {(1, 3), (2, 0), (3, 0), (None, 2), (4, 20_000)}
    assert len({r["tokens_taken"] for r in rows if r["doc_id"] == 1}) == 1
    assert sum(r["tokens_taken"] for r in rows) == pytest.approx(20_023 / 2, abs=8)
    assert mixed(docs_of([])).collect() == []


def test_prefixes_by_brute_force(docs, spark):
    """Each leaf's documents in the order of its last epoch, one after the other until its budget is spent."""
    mix = mixing.Mix(["lang", "source"], [{"en": 2.0, "de": 1.0}, {}], share=0.5, epochs=3)
    got = {r["doc_id"]: r["tokens_taken"] for r in mixing.mixed(docs, mix).collect()}
    rows = docs.collect()
    leaves, tokens = {}, {}
    for r in rows:
        leaf = (r["lang"] or "\x00", r["source"])
        leaves.setdefault(leaf, []).append(r)
        tokens[leaf] = tokens.get(leaf, 0) + len(r["text"].split())
    plan, want = budgets(tokens, mix), {}
    for leaf, members in leaves.items():
        epochs, rest = divmod(plan[leaf], tokens[leaf])

        def place(r):
            row = spark_hash(r["doc_id"], r["text"], r["lang"], r["source"])
            data = xxhash.xxh64_intdigest(mix.seed.to_bytes(4, "little"), 42)
            for v in (epochs, row):
                data = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), data)
            return data  # unsigned, as its leading bits are counted

        for r in sorted(members, key=place):
            n = len(r["text"].split())
            want[r["doc_id"]] = epochs * n + min(n, rest)
            rest -= min(n, rest)
    assert got == want
