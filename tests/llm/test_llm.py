"""Vectors, splitting, packing, leakage and quality against brute force and on odd rows."""

import random

import numpy as np
import pytest

pytest.importorskip("lexweave.llm.vectors")

from lexweave.llm.leakage import RARE, find_leaks, words_of
from lexweave.llm.packing import default_tokenizer, encoder, pack_documents, pack_shard, packing_faults, packing_report, stretches
from lexweave.llm.quality import is_no_prose, quality_outliers, text_statistics
from lexweave.llm.splitting import split_records
from lexweave.llm.vectors import MultiIndex, _spread, kmeans, nearest_vectors, similar_pairs

DIM = 16
VECTORS = "vec_id long, v array<float>, query string, similarity int"


def clustered(seed=1, groups=60, each=8, alone=700):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(groups, DIM))
    rows = [h + 0.25 * rng.normal(size=DIM) for h in heads for _ in range(each)] + list(rng.normal(size=(alone, DIM)))
    return np.array(rows, dtype=np.float32)


def brute(x, ids, k, least):
    u = x.astype(np.float64) / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    out = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i and s[i, j] >= least), key=lambda j: (-round(s[i, j], 6), ids[j]))
        out[ids[i]] = [ids[j] for j in order[:k]]
    return out


def frame(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(a) for a in r], "clash", 1) for i, r in enumerate(x)] + list(extra), VECTORS)


def test_nearest_vectors_find_the_true_neighbours(spark):
    x = clustered()
    odd = [(9001, None, "", 0), (9002, [1.0] * 7, "", 0), (9003, [0.0] * DIM, "", 0), (9004, [float("nan")] * DIM, "", 0), (9005, [None] + [1.0] * (DIM - 1), "", 0), (None, [1.0] * DIM, "", 0), (9006, [], "", 0)]
    near = nearest_vectors(frame(spark, x, odd), "vec_id", "v", k=5, min_similarity=0.8, dim=DIM)
    got: dict[int, set[int]] = {}
    for r in near.collect():
        got.setdefault(r["query"], set()).add(r["other"])
        assert r["query"] != r["other"] and r["query"] < 9000 and r["other"] < 9000
    want = brute(x, list(range(len(x))), 5, 0.8)
    true = sum(len(w) for w in want.values())
    assert sum(len(set(w) & got.get(q, set())) for q, w in want.items()) >= 0.97 * true and max(map(len, got.values())) <= 5
    pairs = similar_pairs(near).collect()
    assert all(p[0] < p[1] for p in pairs) and len(pairs) == len(set(pairs))


def test_nearest_without_threshold_and_with_a_query_set(spark):
    x = clustered(2, groups=20, alone=300)
    near = nearest_vectors(frame(spark, x), "vec_id", "v", k=4, dim=DIM, centroids=8, lists=8, cells=40, query_every=20).collect()
    want = {q: w for q, w in brute(x, list(range(len(x))), 4, -2).items() if q % 20 == 0}
    assert {r["query"] for r in near} == set(want)
    assert sum(r["other"] in want[r["query"]] for r in near) >= 0.9 * 4 * len(want)


def test_blocks_of_hot_centroids_change_nothing(spark, monkeypatch):
    x = clustered(3, groups=4, each=60, alone=100)
    want = sorted(map(tuple, similar_pairs(nearest_vectors(frame(spark, x), "vec_id", "v", k=10, min_similarity=0.8, dim=DIM)).collect()))
    monkeypatch.setattr("lexweave.llm.vectors.BLOCK_ROWS", 7)
    got = sorted(map(tuple, similar_pairs(nearest_vectors(frame(spark, x), "vec_id", "v", k=10, min_similarity=0.8, dim=DIM)).collect()))
    assert got == want and want


def test_blocks_spread_a_query_set(spark, monkeypatch):
    ids = np.arange(0, 200_000, 20)
    for blocks in (2, 4, 5, 10):
        got = np.bincount(_spread(ids, np.full(len(ids), blocks)), minlength=blocks)
        assert got.min() > 0.9 * len(ids) / blocks
    x = clustered(6, groups=4, each=60, alone=100)
    find = lambda: sorted((r["query"], r["other"]) for r in nearest_vectors(frame(spark, x), "vec_id", "v", k=5, dim=DIM, lists=64, cells=4096, query_every=20).collect())
    want = find()
    monkeypatch.setattr("lexweave.llm.vectors.BLOCK_ROWS", 3)
    assert find() == want and want


def test_copies_are_neighbours_by_id(spark):
    x = clustered(4, groups=3, each=4, alone=30)
    many = [(1000 + i, [float(a) * 3 for a in x[0]], "", 0) for i in range(30)]  # same direction, another length
    twin = [(2000, [float(a) for a in x[5]], "", 0), (2000, [float(a) for a in x[5]], "", 0)]
    near = nearest_vectors(frame(spark, x, many + twin), "vec_id", "v", k=5, min_similarity=0.8, dim=DIM)
    got: dict[int, list[int]] = {}
    for r in near.collect():
        got.setdefault(r["query"], []).append(r["other"])
    assert sorted(got[0]) == [1000, 1001, 1002, 1003, 1004] and sorted(got[1010]) == [0, 1000, 1001, 1002, 1003]
    assert 2000 in got[5] and 5 in got[2000] and len(got[2000]) == len(set(got[2000])) <= 5
    assert set(got[5]) - {2000} == set(got[2000]) - {5}


def test_few_or_no_vectors(spark):
    assert nearest_vectors(spark.createDataFrame([], VECTORS), "vec_id", "v", dim=DIM).count() == 0
    assert nearest_vectors(frame(spark, clustered()[:1]), "vec_id", "v", dim=DIM).count() == 0
    assert len(nearest_vectors(frame(spark, clustered()[:3]), "vec_id", "v", k=2, dim=DIM).collect()) == 6


def test_traverse_visits_cells_in_order_of_summed_distance():
    x = clustered(5)
    h = DIM // 2
    books = kmeans(x[:, :h], 12), kmeans(x[:, h:], 12)
    first, taken, second = MultiIndex(books, 12, 20).traverse(x)
    for r in range(0, len(x), 97):
        sums = {(i, j): ((x[r, :h] - books[0][i]) ** 2).sum() + ((x[r, h:] - books[1][j]) ** 2).sum() for i in range(12) for j in range(12)}
        visited = {(first[r, a], second[r, b]) for a in range(12) for b in range(taken[r, a])}
        assert len(visited) == 20 and max(sums[c] for c in visited) <= sorted(sums.values())[19] + 1e-4


PIECES = "row_id long, text string, piece string, start string"


def test_pieces_rebuild_the_text(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 12)))
    prose = lambda n: "".join(word() + rng.choice([" ", " ", " ", ". ", ", ", "\n", "\n\n"]) for _ in range(n))
    texts = [prose(n) for n in (0, 5, 60, 400, 1000)] + ["x" * 1000, "x" * 251, "x" * 250, "\U0001f600é " * 300, "\n\n" * 400, "a " + "b" * 700, None, "  "]
    df = spark.createDataFrame([(i, t, "p", "s") for i, t in enumerate(texts)], PIECES)
    got: dict[int, list] = {}
    for r in split_records(df, "text", ["row_id"], limit=250, overlap=40).orderBy("row_id", "piece").collect():
        got.setdefault(r["row_id"], []).append(r)
    for i, t in enumerate(texts):
        if t is None:
            assert i not in got
            continue
        rows = got[i]
        assert "".join(r["text"][r["shared"] :] for r in rows) == t
        assert all(r["length"] == len(r["text"]) <= 250 and t[r["start"] : r["start"] + r["length"]] == r["text"] for r in rows)
        assert [r["piece"] for r in rows] == list(range(1, len(rows) + 1)) and all(r["n_pieces"] == len(rows) for r in rows)
        assert (len(rows) > 1) == (len(t) > 250) and all(28 <= r["shared"] <= 40 for r in rows[1:])
    cut = [r["text"] for r in got[4][:-1]]
    assert sum(c[-1].isspace() for c in cut) == len(cut)


def test_stronger_boundaries_come_first(spark):
    text = "a" * 150 + ".\n\n" + "b" * 40 + ". " + "c" * 200
    first = lambda t: split_records(spark.createDataFrame([(1, t)], "row_id long, text string"), "text", ["row_id"], limit=240, overlap=20).orderBy("piece").first()["text"]
    assert first(text) == "a" * 150 + ".\n\n"
    assert first("a" * 150 + ".\n" + " " * 40 + "\n" + "b" * 10 + ".\n" + "c" * 200) == "a" * 150 + ".\n"  # a wide blank line is one too


DOCS = "doc_id long, text string, source string, piece string, container string"


def test_packing_places_every_document(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["law", "act", "of", "1999", "ystyr"]) for _ in range(rng.choice([0, 1, 5, 30, 90, 400]))) for _ in range(300)] + [None, "<|endoftext|>", "x" * 5000]
    docs = [(i, t, rng.choice(["big", "big", "big", "small", None]), "p", "c") for i, t in enumerate(texts)]
    packed = pack_documents(spark.createDataFrame(docs, DOCS), "doc_id", "text", "source", capacity=128, shard_tokens=4000, window=4).toPandas()
    enc = encoder(default_tokenizer())
    tokens = {i: len(enc.encode_ordinary(t)) if t else 0 for i, t, *_ in docs}
    assert packed.groupby("doc_id")["n_tokens"].sum().to_dict() == tokens
    assert all((g["piece"].tolist() == list(range(1, len(g) + 1))) and (len(g) > 1) == (tokens[d] > 128) for d, g in packed.sort_values("piece").groupby("doc_id"))
    boxes = packed.sort_values(["container", "offset", "n_tokens"]).groupby("container")
    assert boxes["n_tokens"].sum().max() <= 128
    for _, box in boxes:
        assert (box["offset"].to_numpy() == np.append(0, box["n_tokens"].cumsum().to_numpy()[:-1])).all()
    assert 1 - packed["n_tokens"].sum() / (len(boxes) * 128) < 0.1
    assert packed["container"].nunique() == len(boxes) and set(packed["source"].dropna()) == {"big", "small"}


def test_packing_keeps_target_proportions():
    rng = random.Random(1)
    items = [(n, 1, n % 2, rng.randint(1, 60)) for n in range(4000)]
    out = pack_shard(items, {0: 0.75, 1: 0.25}, {0: 0.0, 1: 0.0}, 64, window=16)
    early = [i for i, p in zip(items, out, strict=True) if p[2] < 40]
    share = sum(i[3] for i in early if i[2] == 0) / sum(i[3] for i in early)
    assert 0.72 < share < 0.78
    late = pack_shard(items, {0: 0.5, 1: 0.5}, {0: 900.0, 1: -900.0}, 64, window=16)  # what earlier shards owe comes first
    first = [i for i, p in zip(items, late, strict=True) if p[2] == 0]
    assert sum(i[3] for i in first if i[2] == 0) > 1.5 * sum(i[3] for i in first if i[2] == 1)


def test_small_source_with_a_target_has_its_own_queue(spark, monkeypatch):
    monkeypatch.setattr("lexweave.llm.packing.QUEUES", 2)
    docs = [(n, "law act of law act of law act", "s" if n % 8 == 0 else "abc"[n % 3], "p", "c") for n in range(800)]
    packed = pack_documents(spark.createDataFrame(docs, DOCS), "doc_id", "text", "source", capacity=64, targets={"s": 0.5}, window=4).toPandas()
    early = packed[packed["container"].isin(sorted(packed["container"].unique())[:8])]
    assert 0.4 < early.loc[early["source"] == "s", "n_tokens"].sum() / early["n_tokens"].sum() < 0.6


def test_proportions_hold_over_several_shards(spark):
    rng = random.Random(3)
    names = [f"s{n}" for n in range(70)]  # more sources than queues
    docs = [(n, "law act of " * rng.randint(1, 20), rng.choice(["a", "b", "c", rng.choice(names)]), "p", "c") for n in range(6000)]
    docs += [(None, "one and the same", "a", "p", "c")] * 400
    targets = {"b": 0.5, "s7": 0.004}
    packed = pack_documents(spark.createDataFrame(docs, DOCS), "doc_id", "text", "source", capacity=128, targets=targets, shard_tokens=40_000, window=48)
    faults = packing_faults(packed, {"b": 0.5}, capacity=128, window=48).first().asDict()
    assert faults.pop("n_docs") == 6400 and faults.pop("n_tokens") > 100_000 and not any(faults.values())
    shards = {r["shard"]: r["count"] for r in packed.where("doc_id IS NULL").groupBy("shard").count().collect()}
    assert len(shards) >= 4 and max(shards.values()) < 200  # rows without id don't meet in one shard


def test_packing_report_and_empty_table(spark):
    empty = pack_documents(spark.createDataFrame([], DOCS), "doc_id", "text", "source")
    assert empty.count() == 0
    docs = spark.createDataFrame([(1, "one two", "a", "", ""), (2, None, None, "", "")], DOCS)
    report = packing_report(pack_documents(docs, "doc_id", "text", "source")).collect()
    assert {r["source"]: (r["n_docs"], r["n_containers"]) for r in report} == {"a": (1, 1), None: (1, 1)}


def test_stretches_don_t_change_the_tokens():
    enc = encoder(default_tokenizer())
    for text in ("word  two\n three 4 five's " * 40, "a" * 900, " " * 700 + "x y z" * 50, "x1-" * 2000, "a" * 600 + "\n" * 300 + " b" * 90):
        assert sum(len(enc.encode_ordinary(s)) for s in stretches(text, 50)) == len(enc.encode_ordinary(text))


ITEM = "A midwife from {} sold the {} mill for {} crowns, but the {} would not pay the {} of {} pence that the old law had set for mills."
PLAIN = "the parish may by order set the rate that a midwife would pay for the mill from the day that it sold the old law had set but not for crowns and of mills"


def leaks(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, passage string, doc_id string")
    return {(r["doc_id"], r["item_id"]): r for r in find_leaks(d, "doc_id", "text", i, "item_id", "passage", **more).collect()}


@pytest.mark.parametrize("bits", [27, 6])
def test_leaks_match_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr("lexweave.llm.leakage.LEAST_BITS", 6)
    monkeypatch.setattr("lexweave.llm.leakage.MOST_BITS", bits)  # a filter that lets much through changes nothing
    rng = random.Random(2)
    items = [(n, ITEM.format(f"Town{n}a", f"Hill{n}b", n + 3, "tenant", "fee", n * 7), "x") for n in range(12)] + [(90, "too short to leak", "x"), (91, None, "x"), (92, PLAIN, "x")]
    noise = lambda: " ".join(rng.choice(PLAIN.split()) for _ in range(rng.randint(0, 60)))
    docs = []
    for n in range(120):
        words = items[rng.randrange(12)][1].split()
        a = rng.randrange(len(words))
        text = f"{noise()} {' '.join(words[a : a + rng.choice([5, 11, 13, 14, 40])])} {noise()}"
        docs.append((n, rng.choice([text, text.upper(), text.replace(" ", " "), text.replace("a", "ａ")]), "x"))
    docs += [(500, None, "x"), (501, "", "x"), docs[0]]
    got = leaks(spark, docs, items)
    grams = lambda t: {tuple(w[k : k + 13]) for w in [words_of(t or "")] for k in range(len(w) - 12)}
    want = {(d, i) for d, t, _ in docs for i, p, _ in items if grams(t) & grams(p)}
    assert {k for k, r in got.items() if r["exact_windows"]} == want and len(want) > 30


def test_reparameterised_items_are_caught(spark):
    own = ITEM.format("Bremby", "Haskacombe", 387, "tenant", "fee", 12)
    items = [(1, own, "x")]
    docs = [
        (1, ITEM.format("Wexford", "Carnmoor", 41, "tenant", "fee", 9), "x"),  # all slots exchanged
        (2, ITEM.format("Wexford", "Carnmoor", 41, "tenant", "fee", 9).replace("sold", "gave"), "x"),  # and the text changed near the start
        (3, "Nothing of it stands here, whatever Bremby did with 387 crowns and the Haskacombe mill that it had.", "x"),
        (4, own, "x"),
    ]
    got = leaks(spark, docs, items)
    assert got[1, 1]["exact_windows"] == 0 and got[1, 1]["swapped_slots"] == 4 and got[1, 1]["swapped_windows"] > 5
    assert (3, 1) not in got and got[4, 1]["exact_windows"] == len(words_of(own)) - 12
    twisted = ITEM.format("Bremby", "Bremby", 387, "tenant", "fee", 387)  # one value of the item would stand for two
    got = leaks(spark, [(7, twisted, "x")], [(1, ITEM.format("Alton", "Alton", 5, "tenant", "fee", 5), "x"), (2, ITEM.format("Alton", "Brook", 5, "tenant", "fee", 6), "x")])
    n = len(words_of(twisted)) - 12
    assert got[7, 1]["swapped_windows"] == n  # of the other item, only stretches that hold one of the two values are consistent
    assert 0 < got[7, 2]["swapped_windows"] < n - 5


def test_one_odd_slot_leaves_the_other_stretches(spark):
    own = "from {} to {} the mill shall be kept by the tenant who sold it and by no other and the fee for {} shall be paid on the day that the old law had set by {} or by the one who sold it"
    item = own.format("Alton", "Brook", "Alton", "Alton")
    doc = own.format("Carn", "Dell", "Eld", "Eld")  # Alton stands for two names, far apart
    got = leaks(spark, [(1, doc, "x")], [(1, item, "x")])[1, 1]
    assert got["swapped_windows"] > 5 and got["exact_windows"] > 0 and got["swapped_slots"] >= 3


def test_slot_heavy_windows_are_found_with_other_values(spark):
    slots = "{} {} {} {} {} {} {} {} {} {} the mill was sold by the old tenant to the law for a fee of the day"
    plain = [(n, t, "x") for n, t in enumerate(["the mill was sold by the old tenant to the law for a fee of the day"])]
    item = (50, slots.format(*(f"Name{c}" for c in "abcdefghij")), "x")
    doc = (1, slots.format(*(f"Other{c}" for c in "klmnopqrst")), "x")
    got = leaks(spark, [doc, (2, " ".join(f"Some{n}" for n in range(40)), "x")], [*plain, item])
    assert got[1, 50]["swapped_slots"] == 10 and not [k for k in got if k[0] == 2]


def test_precision_and_recall_on_planted_copies(spark):
    """Items share a stock sentence; documents hold re-parameterised copies, the stock sentence alone, or neither."""
    rng = random.Random(11)
    vocabulary = [a + b for a in ("par", "mil", "ten", "ord", "cou", "fee", "law", "rat") for b in ("ish", "ler", "ant", "er", "ncil", "ward", "yer", "ing")]
    stock = "explain why the {} of {} lost against {} given that it held {} of the votes"
    bodies = {n: [rng.choice(vocabulary) if rng.random() < 0.8 else "{}" for _ in range(30)] for n in range(30)}
    name = lambda: "".join(rng.choice("bcdfgklmnprstvw") + rng.choice("aeiou") for _ in range(4)).title()

    def fill(template):
        return " ".join(name() if w == "{}" else w for w in template)

    items = [(n, fill(bodies[n]) + ". " + stock.format(name(), name(), name(), rng.randint(100, 999)), "x") for n in bodies]
    docs, want = [], set()
    for d in range(90):
        noise = lambda: " ".join(rng.choice(vocabulary) for _ in range(25))
        n = rng.randrange(30)
        middle = fill(bodies[n]) if d % 3 == 0 else stock.format(name(), name(), name(), rng.randint(100, 999)) if d % 3 == 1 else ""
        docs.append((d, f"{noise()} {middle} {noise()}", "x"))
        if d % 3 == 0:
            want.add((d, n))
    found = leaks(spark, docs, items)
    got = {k for k, r in found.items() if r["rare_windows"] >= RARE}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)


def test_leaks_of_empty_tables(spark):
    assert leaks(spark, [], [(1, PLAIN, "x")]) == {} and leaks(spark, [(1, PLAIN, "x")], []) == {}


COMMON = [("en", w) for w in "the of to and in a is that for it".split()] + [("cy", w) for w in "y yr mae'r i o a".split()] + [("en", None), (None, "x")]
QUALITY = "doc_id long, text string, distance string, language string"


def statistics(text, common):
    words = (text or "").split()
    n = len(words)
    solid = [c for c in text or "" if not c.isspace()]
    lines = [s.strip() for s in (text or "").split("\n") if s.strip()]
    closed = [s for s in lines if s.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", ";", ":")]

    def bare(w):
        w = w.lower()
        while w and not w[0].isalnum():
            w = w[1:]
        while w and not w[-1].isalnum():
            w = w[:-1]
        return w

    lists = {lang: {w for x, w in common if x == lang and w} for lang in ("en", "cy")}
    share = max(sum(bare(w) in ws for w in words) for ws in lists.values()) / n if n else 0.0
    return (n, len(solid) / n if n else 0.0, sum(not c.isalnum() for c in solid) / len(solid) if solid else 0.0, len(closed) / len(lines) if lines else 0.0, share)


def test_statistics_match_brute_force(spark):
    rng = random.Random(4)
    bits = ["the", "(of)", "“mae'r", "Act.”", "y", "§12", "a.", "and;", "x²", "—", "...", "word gap", "tab\tstop", "END:", "Yr", "it's", "10%", "é"]
    texts = [None, "", " \n ", "one", "the end.\n\n(so.)\nno", 'He said "no."  \n'] + ["".join(rng.choice(bits) + rng.choice([" ", "  ", "\n", " \n\n"]) for _ in range(rng.randint(1, 80))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], QUALITY)
    common = {"en": [w for x, w in COMMON if x == "en" and w], "cy": [w for x, w in COMMON if x == "cy"]}
    got = {r["doc_id"]: r for r in text_statistics(df, "text", ["doc_id"], common).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["mean_word_length"], r["symbol_ratio"], r["closed_lines"], r["common_share"]) == pytest.approx(statistics(t, COMMON)), t


def test_outliers_stand_far_from_prose(spark):
    rng = random.Random(8)
    common = spark.createDataFrame(COMMON, "lang string, word string")
    prose = lambda: " ".join(rng.choice(["the", "of", "to", "and", "parish", "council", "order", "member", "rate,", "shall"]) for _ in range(rng.randint(60, 200))) + ".\nThe end of it."
    docs = [(n, prose(), "", "") for n in range(300)] + [(900, "| 1 | 2 | the " * 40, "", ""), (901, None, "", ""), (902, "zzz " * 50, "", "")]
    out = {r["doc_id"]: r for r in quality_outliers(spark.createDataFrame(docs, QUALITY), "text", ["doc_id"], common).collect()}
    assert len(out) == len(docs) and out[901]["distance"] is None and out[902]["language"] is None
    usual = sorted(out[n]["distance"] for n in range(300))
    assert out[900]["distance"] > 3 * usual[-1]
    parts = [out[900][f"from_{s}"] for s in ("log_words", "mean_word_length", "symbol_ratio", "closed_lines", "common_share")]
    assert sum(parts) == pytest.approx(out[900]["distance"] ** 2)
    odd = {r["doc_id"] for r in quality_outliers(spark.createDataFrame(docs, QUALITY), "text", ["doc_id"], common).where(is_no_prose()).collect()}
    assert {900, 901, 902} <= odd and not odd & set(range(300))
    assert quality_outliers(spark.createDataFrame([], QUALITY), "text", ["doc_id"], common).count() == 0
