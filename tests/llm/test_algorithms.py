import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import entries, mixing, names, packing, tokens, topn

PLACES = [(1, "Torlipur", "Fereria", "FE-TOR"), (2, "Galpoito", "Tasoland", "TA-GAL"), (3, "Galpoitu", "Maroria", "MM-GAL"), (4, "Port Novbeito", "Velastan", "VE-POR"), (5, "Marbuabad", "Ulvavia", "UL-MAR"), (6, "Marbuabad", "Fereria", "FE-MAR")]
TITLES = [(1, "Sales Manager"), (2, "Senior Sales Manager"), (3, "Chief Executive Officer"), (4, "Vice President of Sales"), (5, "Finance Manager"), (6, "Laboratory Analyst")]


# ---- top n ---------------------------------------------------------------------------------------------------


def test_top_per_group(spark):
    rows = [(1, "a", "e", 5, "2025-01-01"), (2, "a", "e", 5, "2025-01-02"), (3, "a", "e", None, "2025-01-03"), (4, "a", "e", 9, None), (5, None, "e", 1, None), (6, "a", None, 1, None), (7, "a", "e", 9, None)]
    df = spark.createDataFrame(rows, "id long, domain string, entity_type string, score int, fetched_at string")
    assert sorted(r.id for r in topn.best_contacts(df, 3).collect()) == [2, 4, 5, 6, 7]
    assert topn.best_contacts(df.limit(0)).count() == 0 and topn.top_per_group(df, ["domain"], [F.col("id")], 0).count() == 0
    clash = df.withColumn(topn.RANK, F.lit("x"))
    assert topn.best_contacts(clash, 1).columns == clash.columns


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = topn.top_per_group(df, ["g"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# ---- reference list ------------------------------------------------------------------------------------------


def test_places(spark):
    ref = spark.createDataFrame(PLACES, "ref_id long, name string, area string, code string")
    typed = {"torlpur": 1, "TORLIPUR (Fereria)": 1, "near Torlipur 51894": 1, "Galpoitu": None, "galpoitu, Maroria": 3, "Galpoit, Maroria": 3, "Pt. Novbeito": 4, "Novbeito-Port": 4, "fe-tor": 1, "Marbuabad, Fereria": 6, "marbuabad / ulvavia": 5, "Fereria": 0, "Xanthorpe": 0, "online": 0, "--": 0, "Torlipur": None, "x" * 5000: 0}
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate([*typed, None, "", "torlpur"])], "record_key string, value string")
    out = {r.value: r.ref_id for r in entries.mapped(rows, ref, "place", areas=True).collect()}
    assert out == {k: v for k, v in typed.items() if v is not None}
    assert entries.mapped(rows.limit(0), ref, "place", areas=True).count() == 0
    assert {r.ref_id for r in entries.mapped(rows, ref.limit(0), "place", areas=True).collect()} == {0}


def test_titles(spark):
    ref = spark.createDataFrame(TITLES, "ref_id long, name string")
    typed = {"sales mgr": 1, "Manager, Sales": 1, "Snr Sales Mngr": 2, "C.E.O.": 3, "CEO": 3, "Chief Exec Offcier": 3, "VP Sales": 4, "Vice-President (Sales)": 4, "fin. manager | Torlipur": 5, "Lab Analyst": 6, "Snow Analyst": 0, "Senior Lifeguard": 0, "n/a": 0}
    rows = spark.createDataFrame(list(typed.items()), "value string, want int").select(F.col("value").alias("record_key"), "value")
    places = spark.createDataFrame(PLACES, "ref_id long, name string, area string, code string")
    assert {r.value: r.ref_id for r in entries.mapped(rows, ref, "title", extra=places).collect()} == typed


# ---- names ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b"), [("Anthony Wolzifev", "Tony Wolzifev"), ("A. Lunjudosk", "Anil Lunjudosk"), ("Torna, Michael", "Michael Torna"), ("Xiao Ming Kelleho", "Xiaoming Kelleho"), ("José Wolvugar", "Pepe Wollvugar"), ("Joseph Firhinigar-Firhonalli", "Joseph Firhonalli"), ("Acme Foods and Co", "Acme Foods & Company"), ("Dr. Ann Lee, MBA", "ann  lee")])
def test_names_of_one(a, b):
    assert names.agreement(names.parse(a)[:3], names.parse(b)[:3], frozenset()) >= names.LEAST_AGREEMENT


@pytest.mark.parametrize(("a", "b"), [("Anil Marfomann", "Anila Marfomann"), ("Ivan Torpav", "Ivana Torpav"), ("Mario Zan", "Maria Zan"), ("Noor Vesman", "Olga Vesman"), ("Katherine H. Ostkisk", "Katherine K. Ostkisk"), ("Acme Foods Ltd", "Bolt Foods Ltd")])
def test_names_of_two(a, b):
    common = frozenset("anil anila ivan ivana mario maria noor olga katherine".split())
    assert names.agreement(names.parse(a)[:3], names.parse(b)[:3], common) < names.LEAST_AGREEMENT


def test_linked_pairs(spark):
    people = [(1, "d", "Anthony Wolzifev"), (2, "d", "Tony Wolzifev"), (3, "d", "Wolzifev, Anthony"), (4, "d", "Anthony Wolzifev"), (5, "e", "Tony Wolzifev"), (6, "d", None), (7, "d", ""), (8, "d", "Olga Wolzifev"), (9, "d", "x" * 4000)]
    df = spark.createDataFrame(people, "id long, domain string, name string").selectExpr("*", "cast(null as string) title", "cast(null as string) email", "cast(null as string) phone", "cast(null as string) linkedin")
    assert sorted(map(tuple, names.linked_pairs(df).collect())) == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    assert names.linked_pairs(df.limit(0)).count() == 0


def _nodes(spark, spelt):
    return spark.createDataFrame([(d, n, False) for d, n in spelt], "domain string, norm string, sure boolean")


@pytest.mark.parametrize("chunk", [1000, 5])
def test_similar_is_every_pair_at_the_threshold(spark, chunk):
    given, family = ["robert", "r", "noor", "olga"], ["lunjelli", "lujnelli", "wolpiffi", "woleiffi", "lee"]
    spelt = [(d, f"p:{g} {f}") for d in ("d", "e") for g in given for f in family] + [("f", "c:acme foods"), ("f", "c:acme food"), ("f", "p:"), ("f", "p:" + "x" * 3000)]
    weights = names.rarity(_nodes(spark, spelt))
    got = {(r.domain, r.a, r.b): r.cosine for r in names.similar(_nodes(spark, spelt), weights, None, 0.4, chunk=chunk).collect()}

    def cosine(a, b):
        x, y = set(names.places(a)), set(names.places(b))
        size = lambda s: sum(float(weights[p]) ** 2 for p in s) ** 0.5
        return sum(float(weights[p]) ** 2 for p in x & y) / max(1e-9, size(x) * size(y))

    brute = {(d, min(a, b), max(a, b)): cosine(a, b) for i, (d, a) in enumerate(spelt) for e, b in spelt[:i] if d == e and cosine(a, b) >= 0.4}
    assert got == pytest.approx(brute) and len(brute) > 40


def test_similar_keeps_the_best_of_each_with_ties(spark):
    spelt = [("d", f"p:robert {f}") for f in ("lunjelli", "lunjella", "lunjelly", "marfoman")]
    weights = np.ones(names.BUCKETS, dtype=np.float32)
    every = names.similar(_nodes(spark, spelt), weights, None, 0.1)
    best = {(r.a, r.b) for r in names.similar(_nodes(spark, spelt), weights, None, 0.1, top=1).collect()}
    assert every.count() == 6 and {tuple(f"p:robert lunjell{x}" for x in p) for p in ("ai", "ay", "iy")} < best


def test_nickname_and_slip_are_linked(spark):
    pairs = [("bobby lujnelli", "robert r lunjelli"), ("kit quirben", "christopher s quinben"), ("noor n wolpiffi", "nur woleiffi")]
    people = [(2 * i + k, f"d{i}", n) for i, p in enumerate(pairs) for k, n in enumerate(p)]
    # their shared parts are common, the others rare
    others = [f"{g} {f}" for g in ("lunja", "elli", "lun", "quia", "ben", "wol", "iffi", "nora", "wolei", "belli") for f in ("lumelli", "luzelli", "quimen", "quiroben", "wolbiffi", "wolgiffi", "elliben", "wolquiffi")]
    people += [(100 + i, f"o{i}", n) for i, n in enumerate(others * 8)]
    df = spark.createDataFrame(people, "id long, domain string, name string")
    assert {(0, 1), (2, 3), (4, 5)} <= set(map(tuple, names.linked_pairs(df).collect()))


def _one_by_one(links, least):
    """Average linkage by merging the nearest two clusters at a time."""
    members = {x: {x} for e in links for x in e[:2]}
    weight = {frozenset(e[:2]): e[2] for e in links}
    while True:
        far = []
        for a in members:
            for b in members:
                if a < b:
                    total = sum(weight.get(frozenset((x, y)), 0.0) for x in members[a] for y in members[b])
                    far.append((-total / len(members[a]) / len(members[b]), a, b))
        if not far or -min(far)[0] < least:
            return {x: c for c, xs in members.items() for x in xs}
        _, a, b = min(far)
        members[a] |= members.pop(b)


def test_average_linkage(spark):
    rng = np.random.default_rng(3)
    links = [("1", "2", 0.9), ("3", "4", 0.9), ("2", "3", 0.65)]
    out = {r.node: r.cluster for r in names.average_linkage(spark.createDataFrame([("d", *x) for x in links], names.LINKS), 0.4).collect()}
    assert out["1"] == out["2"] != out["3"] == out["4"]
    links = [(f"{i:02}", f"{j:02}", round(float(rng.random()), 3)) for i in range(14) for j in range(i + 1, 14) if rng.random() < 0.4]
    df = spark.createDataFrame([(d, *x) for d in ("d", "e") for x in links], names.LINKS)
    for least in (0.15, 0.3, 0.6):
        out = {(r.domain, r.node): r.cluster for r in names.average_linkage(df, least).collect()}
        want = _one_by_one(links, least)
        assert out == {(d, x): c for d in ("d", "e") for x, c in want.items()}


def test_copies_of_a_name_never_meet_one_another(spark):
    rows = [(i, "d", "Ann Lee") for i in range(300)] + [(900, "d", "Lee, Ann"), (901, "e", "Ann Lee")]
    out = names.linked_pairs(spark.createDataFrame(rows, "id long, domain string, name string"))
    assert sorted(map(tuple, out.collect())) == [(i, 900) for i in range(300)]


# ---- packing and mixing --------------------------------------------------------------------------------------


def test_hilbert_neighbours_are_adjacent_cells():
    side = np.array([(x, y) for x in range(8) for y in range(8)])
    order = side[np.argsort(packing.hilbert_keys(side, bits=3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_best_fit():
    bins = packing.best_fit([5, 5, 4, 3, 3, 0], 10)
    assert sorted(i for b in bins for i in b) == list(range(6)) and len(bins) == 2


def test_packing(spark):
    texts = [None, "", "pepper " * 30, "steel pipes " * 40, "pepper " * 30, "long text " * 900] + [f"goods number {i} " * (i % 9 + 1) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    specs = spark.createDataFrame([("a", 128), ("b", 512)], "spec string, capacity_tokens int")
    out = packing.packed(docs, specs, partitions=2).collect()
    enc = tokens.encoding(tokens.TOKENIZER)
    for spec, cap in (("a", 128), ("b", 512)):
        rows = [r for r in out if r.spec == spec]
        sizes: dict[int, int] = {}
        for r in rows:
            sizes[r.container] = sizes.get(r.container, 0) + r.tokens
        assert max(sizes.values()) <= cap
        for i, t in enumerate(texts):
            size = len(enc.encode_ordinary(t)) if t else 0
            mine = sorted((r.token_start, r.tokens) for r in rows if r.doc_id == i)
            assert sum(n for _, n in mine) == size and (size > cap or len(mine) == 1)
    assert packing.packed(docs.limit(0), specs).count() == 0


def test_packing_leaves_little_space():
    import pandas as pd

    rng = np.random.default_rng(5)
    sizes = np.minimum(511, rng.lognormal(5, 0.8, 5000).astype(int))
    frame = pd.DataFrame({"spec": "a", "capacity": 512, "key": 0, "doc_id": range(5000), "piece": 0, "token_start": 0, "tokens": sizes})
    out = pd.concat(packing.pack_sorted(iter([frame[:2500], frame[2500:]])))
    assert len(out) == 5000 and out.groupby("container").tokens.sum().max() <= 512
    assert out.container.nunique() <= 1.02 * sizes.sum() / 512 + 1


def test_water_fill():
    got = mixing.water_fill({"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 10.0, "b": 1000.0, "c": 1000.0}, 100.0)
    assert got == pytest.approx({"a": 10.0, "b": 54.0, "c": 36.0})
    assert sum(mixing.water_fill({"a": 1.0}, {"a": 5.0}, 100.0).values()) == 5.0


def test_mixing(spark):
    rows = [(i, f"text number {i} of the source", "big") for i in range(300)] + [(1000 + i, f"small one {i}", "small") for i in range(3)] + [(2000, "small one 0", "small"), (2001, None, "big"), (2002, " ", "big"), (2003, "other", None), (2004, "else", "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.4, 3), ("none", 0.1, 1)], "source string, target_share double, max_repeats int")
    picked, report = mixing.mixed(docs, targets, total_tokens=1000)
    uses = {r.doc_id: r.uses for r in picked.collect()}
    assert {uses[1000 + i] for i in range(3)} == {3} and not set(uses) & {2000, 2001, 2002, 2003, 2004} and max(uses.values()) <= 3
    out = {r.source: r for r in report.collect()}
    assert out["none"].used_tokens == 0 and not out["none"].is_reached and abs(sum(r.used_tokens for r in out.values()) - 1000) < 20
    assert out["none"].holds_up_to == 0 and out["small"].holds_up_to == int(out["small"].available * 3 / 0.4)
    exact = mixing.mixed(docs, targets.filter("source <> 'none'"), total_tokens=out["small"].holds_up_to)[1].collect()
    assert abs(sum(r.used_tokens for r in exact if r.source == "small") - out["small"].available * 3) <= 1
    again = {r.doc_id: r.uses for r in mixing.mixed(docs, targets, total_tokens=1000)[0].collect()}
    assert again == uses
    assert mixing.mixed(docs.limit(0), targets)[0].count() == 0
