"""Every registered query on tables with nulls, empty and long texts, repeated rows, clashing columns, and on empty tables; some against plain Python."""

import hmac
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkloom.llm import language, mixing, pii, quality
from linkloom.llm.queries import queries

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
ITEM = "the quick onyx goblin jumps over a lazy dwarf and then sleeps soundly"
#: Columns of documents that some operator has as columns of its own.
CLASHES = ("score", "held_out", "lang_pred", "n_words", "kept", "component_id", "start", "predicted", "weight", "row", "d", "kk", "id", "tie", "label")


def _tables(spark, where, rows):
    """Small tables of every kind in the folder `where`; rows: whether they hold any."""
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(150):
        w = [rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(rng.randint(12, 50))]
        if i % 6 == 1:
            w[3:3] = ["scumbag", "rotter", "vile"]
        if i % 10 == 3:
            w += ITEM.split()
        if i % 2:
            w = [x.replace("a", "ä") for x in w]
        docs.append((i, " ".join(w) + (f" mail u{i}@site{i % 3}.org" if i % 9 == 0 else ""), "de" if i % 2 else "en", "hot" if i % 3 else f"s{i % 5}"))
        labels.append((i, int(i % 4 != 0), int(i % 6 == 1)))
    docs += [(500, docs[7][1], "de", "hot"), (501, docs[7][1] + " more", None, None), (7, docs[7][1], "de", "hot"), (502, None, "en", "s1"), (503, "", "", ""), (504, " \n", "en", None), (None, "no number here at all", "en", "hot"), (None, None, None, None), (505, "a.b@" * 150_000, "en", "s1"), (506, "word " * 200_000, None, "hot")]
    frame = spark.createDataFrame(docs if rows else [], "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit("clash"))
    frame.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([*labels, (3, None, None), (None, 1, 1), (4, 0, 0)] if rows else [], "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, "of no number"), (4, "unusualitem")] if rows else [], "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)] + [(60, None), (80, [0.0] * 8), (100, [1.0, 2.0]), (40, [1.0] * 8), (None, [1.0] * 8), (120, [float("nan")] * 8)]
    spark.createDataFrame([(*v, 9) for v in vectors] if rows else [], "vec_id bigint, embedding array<float>, score int").write.parquet(f"{where}/embeddings.parquet")
    turns = [(i % 9, i // 9, rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice(["hi", "", None, "x<|im_end|>"])) for i in range(120)] + [(None, None, None, None)] * 5 + [(3, 2, "user", "l" * 1_000_000)]
    spark.createDataFrame([(*t, "clash") for t in turns] if rows else [], "conv_id bigint, turn bigint, role string, text string, fragment string").write.parquet(f"{where}/conversations.parquet")
    return docs, labels


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("odd") / "sf"
    docs, labels = _tables(spark, where, True)
    return str(where), docs, labels


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("empty") / "sf"
    _tables(spark, where, False)
    return str(where)


COLUMNS = {
    "op1_pii": ("doc_id", "text", "pii_types", "n_pii"),
    "op2_toxicity": ("doc_id", "held_out", "score", "predicted"),
    "op3_chat_format": ("conv_id", "pos", "fragment", "conv_cost"),
    "op4_language_id": ("doc_id", "held_out", "lang_pred", "score"),
    "op5_decontamination": ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"),
    "op6_token_store": ("doc_id", "start", "n_tokens", "ids_crc32"),
    "op7_mixing": ("doc_id", "n_tokens", "weight", "probability", "kept"),
    "op8_nearest_neighbours": ("query_id", "rank", "vec_id", "score"),
    "op9_quality": ("doc_id", "held_out", "score", "predicted"),
    "op10_near_dedup": ("doc_id", "n_shingles", "component_id", "kept"),
}
KINDS = {"held_out": "boolean", "score": "double", "predicted": "int", "lang_pred": "string", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint", "query_id": "bigint", "rank": "int", "vec_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "doc_id": "bigint"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_on_odd_and_empty_tables(spark, odd, empty, name):
    where, docs, _ = odd
    out = queries()[name](spark, where)
    for c in COLUMNS[name]:
        assert c in out.columns and (c not in KINDS or out.schema[c].dataType.simpleString() == KINDS[c]), c
    rows = out.collect()
    if "doc_id" in COLUMNS[name]:
        assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    if "held_out" in COLUMNS[name]:
        folds, rest = (5, 0) if name.startswith("op9") else (3, 1)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == rest) and 0 <= r.score <= 1 for r in rows)
    if "predicted" in COLUMNS[name]:
        assert all(r.predicted == int(r.score >= (0.3 if name.startswith("op9") else 0.7)) for r in rows)
    if name == "op3_chat_format":
        assert len(rows) == 126 and len({(r.conv_id, r.pos) for r in rows}) == 126
    if name == "op8_nearest_neighbours":
        assert {r.query_id for r in rows} == {0, 20, 40} and all(r.rank <= 20 and r.vec_id != r.query_id for r in rows)
    assert queries()[name](spark, empty).count() == 0


def test_scores_do_not_depend_on_other_columns(spark, odd, tmp_path):
    where, _, _ = odd
    for name in ("op2_toxicity", "op4_language_id", "op9_quality"):
        first = {r.doc_id: r.score for r in queries()[name](spark, where).where("doc_id > 100").collect()}
        again = {r.doc_id: r.score for r in queries()[name](spark, where).where("doc_id > 100").collect()}
        assert first == again  # trained alike


def _digits(key, kind, n, draw=0):
    return b"".join(hmac.digest(key, f"{kind}|{part}|{n}|{draw}".encode(), "sha256") for part in (0, 1))


def test_pii_surrogates_by_plain_python(spark):
    key = b"k" * 70  # longer than a block of the hash
    said = ["SSN 123-45-6789 at 97.51.17.173, mail Ann.Lee5@Mail4.example.com", "Mr Quorl met Dr Quorl-Zeb"]
    got = [r.text for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(said)), "doc_id int, text string"), key=key).orderBy("doc_id").collect()]

    def drawn(text, stream):
        out = ""
        for c, b in zip(text, stream):
            out += str(b % 10) if c.isdigit() else (chr(97 + b % 26) if c.islower() else chr(65 + b % 26)) if c.isalpha() else c
        return out

    ssn = drawn("123456789", _digits(key, "ssn", "123456789"))
    ip = _digits(key, "ip", "97.51.17.173")
    local, host = "ann.lee5@mail4.example.com", "mail4.example.com"
    mail = drawn("ann.lee5", _digits(key, "local", local)) + "@" + drawn("mail4.example.", _digits(key, "host", host)) + "com"
    mail = "".join(b.upper() if a.isupper() else b for a, b in zip("Ann.Lee5@Mail4.example.com", mail))
    assert got[0] == f"SSN {ssn[:3]}-{ssn[3:5]}-{ssn[5:]} at {1 + ip[0] % 223}.{ip[1]}.{ip[2]}.{ip[3]}, mail {mail}"
    name = drawn("Quorl", _digits(key, "part", "Quorl"))
    assert got[1].startswith(f"Mr {name} met Dr ")
    other = pii.pseudonymise(spark.createDataFrame(list(enumerate(said)), "doc_id int, text string"), key="another").orderBy("doc_id").first().text
    assert other != got[0]


def test_pii_takes_long_texts_in_linear_time(spark):
    for text in ("x@" + "a." * 2000 + "com", "a." * 500_000, "a@" * 200_000, "1 " * 300_000, "A-" * 200_000):
        row = pii.pseudonymise(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()[0]
        assert len(row.text) == len(text)


def test_pii_key_stays_out_of_plans_and_collisions_end_in_distinct_or_an_error(spark):
    said = [f"call x{a}@b.org now" for a in "abcdefghijklmnopqrstuvwxyz"] + ["Mr Smith", "Mr John Smith"]
    out = pii.pseudonymise(spark.createDataFrame(list(enumerate(said)), "doc_id int, text string"), key="topsecretkey")
    plan = out._jdf.queryExecution().toString()
    assert "topsecretkey" not in plan and b"topsecretkey".hex() not in plan.lower()
    text = [r.text for r in out.orderBy("doc_id").collect()]
    assert len(set(text)) == len(text) and text[-1].split()[-1] == text[-2].split()[-1]
    space, column = pii.Workspace(spark, "t"), pii._key_column(spark, b"k")
    full = spark.range(1000).selectExpr("'secret' AS kind", "lpad(CAST(id AS STRING), 3, '0') AS n")  # every string of three digits
    with pytest.raises(ValueError, match="kind secret"):
        pii.redrawn(full, column, space, rounds=2)


def _plain_buckets(text):
    data = [c + 32 if 65 <= c <= 90 else c for c in text.encode()]
    data = [c if 97 <= c <= 122 or c >= 128 else 0 for c in data] + [0] * 5
    out = []
    for i in range(len(text.encode())):
        for size in language.GRAMS:
            g = data[i : i + size]
            if 0 in g[1:-1] or (g[0] == 0 and g[-1] == 0):
                continue
            total = sum((c + 1) * int(m) for c, m in zip(g, language._MULT)) % 2**32
            mixed = (total ^ (total >> 15)) * 0x2C1B3C6D % 2**32
            out.append((mixed ^ (mixed >> 13)) & (language.BUCKETS - 1))
    return out


def test_language_prediction_by_plain_python(spark, odd, monkeypatch):
    where, docs, _ = odd
    table = spark.read.parquet(f"{where}/documents.parquet").where("length(text) < 2000 OR text IS NULL").select("doc_id", "text", "lang")
    model = language.fit(table)
    monkeypatch.setattr(language, "WINDOW", 64)
    for r in language.detect(table, model).where("row.doc_id IS NOT NULL AND lang_pred <> 'und'").collect():
        at = _plain_buckets(r.row.text)
        z = (sum(model.table[k].astype(float) for k in at) / max(1, len(at)) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.langs[int(p.argmax())] and math.isclose(r.score, p.max(), rel_tol=1e-4)


def test_many_languages_and_long_training_texts(spark):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k * 40 + i, "".join(rng.choice([letters[k % 26] * 2 + letters[k // 26] + " ", letters[k // 26] + letters[k % 26] + "q "]) for _ in range(40 if i else 20_000)), f"l{k:03}") for k in range(60) for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(table)
    assert len(model.langs) == 60
    assert np.mean([r.lang_pred == r.row.lang for r in language.detect(table, model).collect()]) > 0.9


def test_mixing_weights_by_plain_raking(spark, odd):
    where, docs, _ = odd
    docs = [d for d in docs if len(d[1] or "") < 2000]  # without the text that is most of all tokens, with which the targets contradict each other
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    rows = mixing.cell_weights(table).collect()
    cells = {(r.source, r.lang, r.topic): float(r.tokens) for r in rows}
    topics = {(r.row.doc_id, r.row.text): r.topic for r in mixing.measured(table).collect()}
    plain = defaultdict(float)
    for doc_id, text, lang, source in docs:
        plain[source or "", lang or "", topics[doc_id, text]] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert dict(plain) == cells
    now, total = dict(cells), sum(cells.values())
    for _ in range(400):
        for m, name in enumerate(mixing.MARGINS):
            have, had = Counter(), Counter()
            for c, v in now.items():
                have[c[m]] += v
                had[c[m]] += cells[c]
            powers = {k: v ** mixing.TEMPER[name] for k, v in had.items() if v > 0}
            now = {c: v * (total * powers[c[m]] / sum(powers.values()) / have[c[m]] if have[c[m]] > 0 else 1) for c, v in now.items()}
    for r in rows:
        if r.tokens:
            assert math.isclose(r.weight, now[r.source, r.lang, r.topic] / r.tokens, rel_tol=1e-4)


def test_quality_statistics_by_plain_python(spark, odd):
    _, docs, _ = odd
    texts = [t or "" for _, t, *_ in docs if len(t or "") < 2000] + ["One, two; TWO two! 3x", "x\ny\nx"]
    raw = b"".join(t.encode() for t in texts)
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    got = quality.statistics(np.frombuffer(raw, np.uint8), offs)
    for text, row in zip(texts, got):
        data, own = text.encode(), dict(zip(quality.STATISTICS, row))
        w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", data)]
        n = max(1, len(w))
        longest, run = (1 if w else 0), 1
        for a, b in zip(w, w[1:]):
            run = run + 1 if a == b else 1
            longest = max(longest, run)
        want = {
            "n_bytes": len(data), "n_words": len(w), "word_bytes": sum(map(len, w)) / n, "upper": len(re.findall(rb"[A-Z]", data)) / max(1, len(data)), "digits": len(re.findall(rb"\d", data)) / max(1, len(data)), "lines": data.count(b"\n") / n,
            "non_ascii": sum(c >= 128 for c in data) / max(1, len(data)), "stops": sum(c in b".,;:?" for c in data) / max(1, len(data)), "distinct_words": len(set(w)) / n, "top_word": max(Counter(w).values(), default=0) / n,
            "twice_in_row": sum(a == b for a, b in zip(w, w[1:])) / n, "long_run": longest, "distinct_pairs": len(set(zip(w, w[1:]))) / max(1, len(w) - 1), "short_words": sum(len(x) <= 3 for x in w) / n,
        }
        for k, v in want.items():
            assert math.isclose(own[k], v, rel_tol=1e-9, abs_tol=1e-12), (k, text[:40])


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_stage_by_stage(spark, odd):
    from tokenizers import Tokenizer

    from linkloom.llm.token_store import default_tokenizer

    where, docs, _ = odd
    state, names = spark.read.parquet(f"{where}/documents.parquet"), None
    names = state.columns
    key = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = state.select("doc_id", "text").collect()
        state = stage(spark, state, where).persist()
        assert state.columns == names
        seen[name] = (before, state.select("doc_id", "text", "lang", "source").collect())
    before, after = seen["language_id"]
    letters = [r for r in before if any(c.isalpha() for c in r.text or "")]
    assert not key(after) - key(letters) and len(after) >= 0.98 * len(letters)
    before, after = seen["minhash_near_dedup"]
    sets = [(r.doc_id, r.text, _shingles(r.text)) for r in before]
    link = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    comp = {r[0]: r[0] for r in sets if r[0] is not None}
    for _ in sets:
        moved = [(i, comp[j]) for i, _, a in sets for j, _, b in sets if i is not None and j is not None and link(a, b) and comp[j] < comp[i]]
        if not moved:
            break
        for i, c in moved:
            comp[i] = min(comp[i], c)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(i for i, c in comp.items() if i == c)
    before, after = seen["benchmark_decontamination"]
    item = ITEM.split()
    held = lambda t: any(item[k : k + 10] == w[i : i + 10] for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())] for k in range(len(item) - 9) for i in range(len(w) - 9)) or any(x in (t or "") for x in ("unusualitem", "of no number"))
    assert key(after) == key([r for r in before if not held(r.text)])
    before, after = seen["mixing"]
    assert not key(after) - key(before) and 0 < len(after) <= len(before)
    tok, start = Tokenizer.from_file(default_tokenizer()), 0
    out = corpus_pipeline.STAGES[-1][1](spark, state, where).orderBy("start").collect()
    for r, (doc_id, text) in zip(out, sorted(((r.doc_id, r.text or "") for r in after), key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_pipeline_run_on_odd_and_empty_tables(spark, odd, empty):
    assert corpus_pipeline.run(spark, odd[0]).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0

