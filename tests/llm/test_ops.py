"""The training-data operators against brute force, on small fixtures with nulls, empty and long texts, ties and repeats."""

import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import ann, chat, decontam, language, mixing, neardup, pii, quality, token_store, toxicity

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    for i in range(40):  # near copies, chained
        words = made[i % 12].split()
        words[rng.randrange(len(words))] = "changed%d" % i
        made.append(" ".join(words))
    return [*made, made[0], made[0].upper(), "", " \n\t ", None, "one", "one", " nbsp stays", "long " * 30000]


def _docs(spark, texts, **more):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumns({k: F.lit(v) for k, v in more.items()})


def _sets(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _components(texts, size):
    sets, comp = [_sets(t, size) for t in texts], list(range(len(texts)))
    for _ in range(len(texts)):
        moved = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and comp[j] < comp[i]:
                    comp[i], moved = comp[j], True
        if not moved:
            return sets, comp


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_are_the_brute_force_components(spark, texts, size):
    sets, comp = _components(texts, size)
    got = {r.doc_id: r for r in neardup.near_duplicates(_docs(spark, texts, n=1, key="x"), size=size).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == comp
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_finds_what_large_buckets_leave(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    made = []
    for _ in range(150):
        w = list(base)
        for i in rng.sample(range(120), rng.randint(0, 9)):
            w[i] = f"x{rng.randint(0, 10**6)}"
        made.append(" ".join(w))
    _, comp = _components(made, 2)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(_docs(spark, made), size=2, small=2).collect()}
    assert [got[i] for i in range(len(made))] == comp


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "d e f"), (2, "d e f"), (2, "d e f")]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size=2).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False)]
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_decontamination_by_brute_force(spark):
    rng = random.Random(1)
    words = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, " ".join(words(n))) for i, n in enumerate([12, 30, 3, 10, 1, 0])] + [(9, None), (None, " ".join(words(11)))]
    items[4] = (4, "unusual!")
    docs = []
    for i in range(40):
        w = words(30)
        if i % 3 == 0:
            w[5:5] = (items[i % 4][1] or "").upper().split()
        if i % 5 == 0:
            w += ["Unusual", "x"]
        docs.append("; ".join(w))
    docs += [None, "", "...", " ".join(items[7][1].split())]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    want = []
    for i, d in enumerate(docs):
        w, hit, found = split(d), set(), set()
        for item, text in items:
            b = split(text)
            n = min(10, len(b))
            for k in range(len(b) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == b[k : k + n]:
                        hit |= set(range(at, at + n))
                        found |= {str(item)} if item is not None else set()
        want.append((i, len(w), len(hit), sorted(found)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (500_000, 7):  # one pass, or many slices
        out = decontam.find_contamination(_docs(spark, docs, n_words="clash"), bench, max_windows=limit)
        assert sorted((r.row.doc_id, r.n_words, r.n_hit, sorted(r.found["items"])) for r in out.collect()) == want
    kept = decontam.decontaminate(_docs(spark, docs), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, hit, _ in want if not hit]
    cut = {r.doc_id: r.text for r in decontam.decontaminate(_docs(spark, docs), bench, mode="span").collect()}
    for i, n, hit, _ in want:
        assert len(split(cut[i])) == n - hit and (hit or cut[i] == docs[i])


def test_token_store_round_trip(spark, texts, tmp_path):
    from tokenizers import Tokenizer

    more = [*texts, "don't 'tis a<|endoftext|>b x,y.z 12a é İ Σας \u0085x", "word." * 400]
    docs = _docs(spark, more).orderBy(F.desc("doc_id")).union(spark.createDataFrame([(None, "no id"), (3, "again")], "doc_id bigint, text string"))
    got = token_store.store_round_trip(docs).orderBy("start").collect()
    tok = Tokenizer.from_file(token_store.default_tokenizer())
    rows = sorted([(r.doc_id, r.text or "") for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_store.store_round_trip(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for values in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 10**12, 1000)), np.arange(3000), np.sort(rng.integers(0, 50, 999))):
        coded, _ = token_store.EliasFano.from_bytes(memoryview(token_store.EliasFano.of(np.array(values)).to_bytes()))
        assert coded.values().tolist() == list(values)
        assert [coded.select(i) for i in range(0, len(values), 7)] == [int(values[i]) for i in range(0, len(values), 7)]
    block = token_store.Block(token_store.pack_block([None, -4, 7], np.array([1, 0, 2]), np.array([9, 8, 7]), 2))
    assert block.doc_ids() == [None, -4, 7] and [block.document(i).tolist() for i in range(3)] == [[9], [], [8, 7]]


def _best(at, scores, n, drift):
    """All maximal scoring segments by their definition: the best segment, then the same to its left and right."""
    line = [-drift] * n
    for p, s in zip(at, scores):
        line[p] = s

    def run(lo, hi):
        top = max(((sum(line[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
        return [] if top[0] <= 1e-12 else [*run(lo, top[3]), (top[3], top[4], round(top[0], 6)), *run(top[4], hi)]

    return run(0, n)


def test_segments_are_all_maximal_ones():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 25)
        at = sorted(rng.sample(range(n), rng.randint(0, n // 2)))
        scores = [rng.uniform(0.2, 3) for _ in at]
        line = np.full(n, -0.7)
        line[at] = scores
        sums = np.concatenate(([0.0], np.cumsum(line)))
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(at, sums[at], sums[np.array(at, int) + 1])]
        assert got == _best(at, scores, n, 0.7)


def test_segments_are_linear():
    n = 1_000_000
    for gap in (0.7, 1.5):  # one growing segment, or a million short ones
        sums = np.cumsum(np.tile([1.0, -gap], n))
        began = time.time()
        found = toxicity.segments(range(0, 2 * n, 2), (sums[::2] - 1.0).tolist(), sums[::2].tolist())
        assert len(found) == (1 if gap < 1 else n) and time.time() - began < 20


def test_extreme_value_fit_finds_the_parameters():
    rng = np.random.default_rng(3)
    n = rng.integers(20, 2000, 20_000)
    best = (np.log(0.02 * n) - np.log(rng.exponential(size=len(n)))) / 1.3  # Gumbel
    rate, constant = toxicity.extreme_values(n, np.maximum(best, 0))
    assert abs(rate - 1.3) < 0.05 and abs(constant / 0.02 - 1) < 0.15


def _labelled(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        toxic, junk = i % 5 == 0, i % 4 == 1
        w = [rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(20, 60))]
        if toxic:
            w[3:3] = rng.sample(["vile", "scumbag", "rotter", "swine"], 3)
        docs.append((i, " ".join(x + "%%%" for x in w) if junk else " ".join(w), "en" if i % 2 else None))
        labels.append((i, int(not junk), int(toxic)))
    docs += [(1000, None, None), (1001, "", None), (None, "alpha", "en")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame([*labels, (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")


def test_toxicity_and_quality_on_held_out_rows(spark):
    docs, labels = _labelled(spark)
    truth = {r.doc_id: r for r in labels.where("quality IS NOT NULL").collect()}
    scored = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert np.mean([(scored[i].score >= 0.7) == (truth[i].toxic == 1) for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]) > 0.97
    assert 0 <= scored[1000].score < 0.5 and scored[1001].score == scored[1000].score and scored[5].passages
    rated = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert np.mean([(rated[i] >= 0.3) == (truth[i].quality == 1) for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]) > 0.97
    none = labels.where("false")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.5}
    assert quality.score(docs, quality.fit(docs, none)).where("score = 0.5").count() == docs.count()


def test_rules_compile_to_the_model_itself(spark):
    docs, labels = _labelled(spark)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).toPandas()
    want = 1 / (1 + np.exp(-model.margin(rows[list(quality.STATISTICS)].to_numpy(float))))
    assert np.allclose(rows["score"], want) and model.rules


def test_language(spark):
    rng = random.Random(6)
    kinds = {"aa": ["tok", "lor", "min"], "bb": ["sché", "ungü", "keit"]}
    docs = [(i, " ".join("".join(rng.choice(p) for _ in range(2)) for _ in range(rng.randint(3, 40))), k if i % 7 else None) for i, (k, p) in enumerate([*kinds.items()] * 150)]
    odd = [(900, None, "aa"), (901, "123 !!", "bb"), (902, "", None), (None, "tok", "aa")]
    table = spark.createDataFrame([*docs, *odd], "doc_id bigint, text string, lang string")
    got = {r.row.doc_id: r for r in language.detect(table, language.fit(table)).collect()}
    assert np.mean([got[i].lang_pred == ("aa", "bb")[i % 2] for i in range(300)]) > 0.99
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (900, 901, 902))
    assert {r.lang_pred for r in language.detect(table, language.fit(table.where("false"))).collect()} == {"und"}
    kept = language.keep_identified(table)
    assert kept.columns == table.columns and kept.where("doc_id >= 900").count() == 0


def test_mixing_meets_its_targets(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(WORDS) + "longer" for _ in range(rng.randint(5, 30))), rng.choice(["en", "de", None]), "hot" if rng.random() < 0.6 else rng.choice(["s1", "s2"]), f"t{rng.randint(0, 2)}") for i in range(1500)]
    table = spark.createDataFrame([*docs, (2000, None, "en", "s1", "t0"), (None, "x", "en", "hot", "t1")], "doc_id bigint, text string, lang string, source string, topic string")
    target = {"source": {"hot": 0.4, "s1": 0.4, "s2": 0.2}}
    for cells in (200_000, 1):  # on the driver, or by jobs over the table of cells
        rows = mixing.mix(table, target, keep=0.3, max_cells=cells).select("row.source", "n_tokens", "weight", "probability", "kept").toPandas()
        share = (rows["n_tokens"] * rows["weight"]).groupby(rows["source"]).sum()
        assert np.allclose((share / share.sum())[["hot", "s1", "s2"]], [0.4, 0.4, 0.2], atol=1e-4)
        assert abs((rows["n_tokens"] * rows["probability"]).sum() / rows["n_tokens"].sum() - 0.3) < 1e-3
        assert abs(rows["kept"].sum() - rows["probability"].sum()) < 80
    assert mixing.mix(table.where("false")).count() == 0


def test_mixing_probabilities_meet_the_targets(spark):
    rng = random.Random(12)
    pick = lambda values, shares: rng.choices(values, shares)[0]
    docs = [(i, " ".join(["word"] * rng.randint(5, 30)), pick(["en", "de", "es", "fr"], [61, 15, 9, 15]), "hot" if rng.random() < 1 / 3 else f"s{rng.randint(1, 19)}", f"t{rng.randint(0, 7)}") for i in range(6000)]
    table = spark.createDataFrame([*docs, (7000, "", "xx", "s1", "t0")], "doc_id bigint, text string, lang string, source string, topic string")
    found = []
    for cells in (200_000, 1):  # on the driver, or by jobs over the table of cells
        rows = mixing.cell_weights(table, keep=mixing.KEEP, max_cells=cells, tries=2).toPandas().sort_values(list(mixing.MARGINS))
        found.append(rows[["weight", "probability"]].to_numpy())
        drawn, kept = rows["tokens"] * rows["probability"], (rows["tokens"] * rows["probability"]).sum() / rows["tokens"].sum()
        most = mixing.KEEP
        for m, temper in mixing.TEMPER.items():
            have = rows["tokens"].groupby(rows[m]).sum()
            have = have[have > 0]
            target = have**temper / (have**temper).sum()
            got = drawn.groupby(rows[m]).sum()[have.index]
            assert np.allclose(got / got.sum(), target, atol=1e-4), m
            most = min(most, (have / have.sum() / target).min())
        assert rows["probability"].between(0, 1).all() and kept <= mixing.KEEP + 1e-6
        assert kept > 0.95 * most  # raked under the bound, close to what any sample can keep
    assert np.allclose(*found, rtol=1e-6)
    spread = mixing.cell_weights(table, {"lang": {"en": 0.5, "de": 0.2}}, keep=0.5).toPandas()
    assert abs((spread["tokens"] * spread["probability"]).sum() / spread["tokens"].sum() - 0.5) < 1e-5


def _legal(roles):
    state = chat.START
    for r in roles:
        if r not in chat.LEGAL[state]:
            return False
        state = r
    return state in chat.ACCEPT


def _cheapest(codes):
    """Brute force over states, turn by turn, with the costs written out."""
    best = {chat.START: 0}
    insert = lambda b: _closure(b)

    def _closure(b):
        b = dict(b)
        for _ in range(4):
            for s, c in list(b.items()):
                for t in chat.LEGAL[s]:
                    if t != chat.SYSTEM:
                        b[t] = min(b.get(t, 99**9), c + 4)
        return b

    for r in codes:
        now = {}
        for s, c in best.items():
            if s != chat.START:
                now[s] = min(now.get(s, 99**9), c + 2 + (0 if s == r else 3 if r else 1))
        for s, c in insert(best).items():
            for t in chat.LEGAL[s]:
                now[t] = min(now.get(t, 99**9), c + (0 if t == r else 3 if r else 1))
        best = now
    return min(c for s, c in insert(best).items() if s in chat.ACCEPT)


def test_chat_repair(spark):
    rng = random.Random(11)
    names = ["system", "user", "assistant", "tool", None, "User "]
    convs = {i: [rng.choice(names) for _ in range(rng.randint(1, 9))] for i in range(60)} | {100: ["user", "assistant"] * 20}
    rows = [(i, t, r, f"text {t} <|im_end|>" if t % 3 else None) for i, roles in convs.items() for t, r in enumerate(roles)]
    for chunk in (4096, 4):  # whole conversations, or cut into chunks
        out = chat.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), chunk=chunk).toPandas()
        assert len(out) == len(rows)
        for i, roles in convs.items():
            own = out[out.conv_id == i].sort_values("pos")
            assert own.pos.tolist() == own.turn.tolist() == list(range(len(roles)))
            whole = "".join(own.fragment)
            heads = re.findall(r"<\|im_start\|>(\w+)\n", whole)
            assert _legal([chat.ROLES.index(h) + 1 for h in heads]) and whole.count("<|im_end|>") == len(heads) and whole.endswith("<|im_end|>\n")
            assert set(own.conv_cost) == {_cheapest([chat.role_code(r) for r in roles])}


def test_chat_repair_of_one_hot_conversation_without_numbers(spark):
    rows = [(None, None, ["user", "assistant", None][i % 3], f"text {i % 50}") for i in range(3000)] + [(7, 1, "user", "same")] * 40 + [(8, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3).withColumn("pos", F.lit("clash"))
    out = chat.repair(table, chunk=64).toPandas()
    assert len(out) == len(rows)
    for conv, n in ((None, 3000), (7, 40), (8, 1)):
        own = out[out.conv_id.isna() if conv is None else out.conv_id == conv].sort_values("pos")
        assert own.pos.tolist() == list(range(n)) and own.role.fillna("").tolist() == sorted(own.role.fillna(""))
        whole = "".join(own.fragment)
        assert _legal([chat.ROLES.index(h) + 1 for h in re.findall(r"<\|im_start\|>(\w+)\n", whole)]) and whole.endswith("<|im_end|>\n")
        assert set(own.conv_cost) == {_cheapest([chat.role_code(r) for r in own.role.fillna("")])}
    assert chat.repair(table.where("false")).count() == 0


def test_pii_surrogates(spark):
    said = ["Mail a.55@mail4.example.com or A.55@mail4.example.com, call +1 (017) 555-7713.", "card 4111 1111 1111 1111, not 4111111111111112, ip 97.51.17.173.", "Mr John Smith met Mrs Müller; Mr Smith left.", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" SSN 123-45-6789 IBAN DE89 3704 0044 0532 0130 00', None, "", "nothing here v1.2.3.4.5", "again 97.51.17.173!!", "odd \u0001\u0002\u0001 97.51.17.173 end"]
    got = [r for r in pii.pseudonymise(_docs(spark, said, m="x", r="y")).orderBy("doc_id").collect()]
    text = [r.text for r in got]
    for secret in ("a.55@", "555-7713", "4111 1111 1111 1111", "97.51.17.173", "John", "Smith", "Müller", "04dbebab", "123-45-6789", "0532 0130"):
        assert not any(secret in (t or "") for t in text)
    assert text[4:7] == [None, "", said[6]] and "4111111111111112" in text[1]
    ip = re.search(r"ip (\S+)\.", text[1])[1]
    assert text[7] == f"again {ip}!!" and text[8] == f"odd \u0001\u0002\u0001 {ip} end"
    first, last = re.match(r"Mr (\w+) (\w+) met", text[2]).groups()
    assert first in pii.GIVEN["latin", "m"] and f"Mr {last} left" in text[2]
    card = [int(c) for c in re.search(r"card ([\d ]+),", text[1])[1] if c.isdigit()]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(card))) % 10 == 0
    assert [r.n_pii for r in got] == [3, 2, 3, 3, 0, 0, 0, 1, 1]


def test_pii_hexadecimal_credentials_in_capitals(spark):
    rng = random.Random(4)
    made = ["".join(rng.choice(digits) for _ in range(n)) for digits in ("0123456789ABCDEF", "0123456789abcdef", "0123456789abcDEF") for n in (32, 40, 64)]
    out = [r.text for r in pii.pseudonymise(_docs(spark, [f'TOKEN = "{t}"' for t in made])).where("pii_types = array('secret') AND n_pii = 1").orderBy("doc_id").collect()]
    assert len(out) == len(made)
    for old, text in zip(made, out):
        new = re.fullmatch(r'TOKEN = "([0-9A-Fa-f]+)"', text)[1]
        assert new != old and [(c.isdigit(), c.isupper()) for c in new] == [(c.isdigit(), c.isupper()) for c in old]


def test_pii_collisions_are_drawn_again(spark):
    said = [f"Call {a}{b}{c}-{d}{e}-0000 now" for a in range(3) for b in range(10) for c in range(10) for d, e in ((0, 0), (1, 1), (2, 2))] * 2
    # ssn surrogates have nine digits; short hosts collide far more often
    said += [f"x@{a}.org" for a in "abcdefghijklmnopqrstuvwxyz"]
    out = pii.pseudonymise(_docs(spark, said)).orderBy("doc_id").collect()
    pairs = {(s, r.text) for s, r in zip(said, out)}
    assert len({s for s, _ in pairs}) == len(pairs) == len({t for _, t in pairs})
    assert not {t for _, t in pairs} & set(said)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    made = rng.normal(size=(900, 12)).astype(np.float32)
    made[300:360] = made[300]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(made)] + [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (2060, [1.0] * 3), (2080, [None] * 12), (None, [1.0] * 12)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest(table, F.pmod("vec_id", F.lit(20)) == 0).toPandas()
    v = made.astype(float)
    recall = []
    for q in range(0, 900, 20):
        scores = v @ v[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:20]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own.score, scores[own.vec_id])
        recall.append(len(set(order) & set(own.vec_id)) / 20)
        if q == 300:
            assert own.vec_id.tolist() == list(range(301, 321))
    assert np.mean(recall) > 0.95 and set(got.query_id) == set(range(0, 900, 20))
    few = ann.nearest(table.where("vec_id < 5 OR vec_id IS NULL"), F.col("vec_id") == 0)
    assert few.count() == 4 and ann.nearest(table.where("false"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("sample", [4096, 200])
def test_nearest_neighbours_of_unequal_lengths(spark, monkeypatch, sample):
    monkeypatch.setattr(ann, "SAMPLE", sample)  # bands in full, or by their graphs
    rng = np.random.default_rng(2)
    made = rng.normal(size=(1500, 24))
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    made[700:1400] *= 1.4  # two large bands
    made[1400:] *= np.exp(rng.normal(size=(100, 1)))
    made[[3, 40, 500, 720, 1100]] *= 100
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id bigint, embedding array<double>")
    got = ann.nearest(table, F.pmod("vec_id", F.lit(20)) == 0).toPandas()
    recall = []
    for q in range(0, 1500, 20):
        scores = made @ made[q]
        order = sorted((i for i in range(1500) if i != q), key=lambda i: (-scores[i], i))[:20]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own.score, scores[own.vec_id])
        recall.append(len(set(order) & set(own.vec_id)) / 20)
    assert np.mean(recall) > 0.95


def test_neighbour_search_goes_on_until_nothing_is_left(spark):
    # nodes on a ring, each linked to the next ones only: the far side takes many rounds
    n, ahead = 40, 2
    rng = np.random.default_rng(5)
    code = np.column_stack((np.linspace(1, 100, n), rng.integers(1, 3, n))).astype(np.int8)
    codes = spark.createDataFrame([(i, bytearray(c.tobytes()), bytearray(np.array([100, 0], np.int8).tobytes())) for i, c in enumerate(code)], "id bigint, code binary, q_code binary")
    graph = spark.createDataFrame([(i, [(0, (i + j) % n) for j in range(1, ahead + 1)]) for i in range(n)], f"id bigint, nbrs {ann._LIST}")
    begin = spark.createDataFrame([(0, 0, [((1 << 31) - 1, 0)])], f"q bigint, band int, near {ann._LIST}")
    near = ann.search(begin, codes, graph, ann.Workspace(spark, "ring"), beam=64, expand=24).first()["near"]
    assert {x.id for x in near} >= set(range(n - 3, n))


def test_pipeline_keeps_one_document_of_each_group(spark):
    from corpus_pipeline import drop_near_duplicates

    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text, "a"), (5, text.upper(), "b"), (8, text + " more", "c"), (9, "something else entirely here now", None), (9, "a second text of one id", "d"), (11, "", "e"), (12, None, "f"), (None, text, "g"), (None, None, "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    kept = drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.key or "") for r in kept.collect()) == [(0, "g"), (0, "h"), (3, "a"), (9, "d"), (11, "e"), (12, "f")]
    assert drop_near_duplicates(spark, docs.where("false"), SF).count() == 0
