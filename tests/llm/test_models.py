"""Held-out accuracy of the trained models, and their defined results at the edges."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyspark.llm.common import mix
from tallyspark.llm.language_id import ByteCNN, identify_languages, predict
from tallyspark.llm.sampling import bounded_sample
from tallyspark.llm.toxicity import LENGTH, STRIDE, TRIGRAMS, ToxicityNet, Words, score, score_toxicity, without_toxic
from tallyspark.llm.transcripts import STATES, STYLES, RoleHMM, features, format_chats, raw_log, recover_turns, split_marker, train

SF = "/root/testdata/sf0.1"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify_languages(docs, 300).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_language_edges(spark):
    rows = [(i, "der und die das nicht " * 9, "de", "x") for i in range(20)] + [(i, "the and of that with " * 9, "en", "x") for i in range(20, 40)]
    docs = spark.createDataFrame(rows + [(90, None, "de", ""), (91, "12 ½ ² Ⅷ ,,", None, ""), (None, "the and of", None, ""), (92, "und nicht die " * 30_000, None, "")], "doc_id long, text string, lang string, score string")
    got = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in identify_languages(docs).collect()}
    assert got[90][0] == got[91][0] == "und" and got[92][0] == "de" and got[None] == ("en", False) and len(got) == 44
    assert identify_languages(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    good, bad = got.score[got.toxic == 0].values, got.score[got.toxic == 1].values
    assert np.mean([(x > good).mean() for x in bad]) > 0.9
    assert got.predicted[got.toxic == 0].mean() < 0.05


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, ("you vile rat " if i % 2 else "a fine day ") * 3, "s") for i in range(60)] + [(None, "you vile rat", ""), (80, None, ""), (81, "", ""), (82, "a fine day " * 20_000 + "you vile rat", "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(docs, labels).collect()}
    assert got[None]["predicted"] == 1 and got[82]["predicted"] == 1 and got[0]["predicted"] == 0 and 0 <= got[80]["score"] == got[81]["score"] <= 1
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= set(range(0, 60, 2))
    assert {r["score"] for r in score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert score_toxicity(docs.limit(0), labels).count() == 0


def test_samples_agree_on_reruns(spark):
    rows = spark.range(4000).select((F.col("id") % 3000).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), (F.col("id") % 3).cast("int").alias("k"))
    one, other = (sorted(map(tuple, bounded_sample(x, "k", "doc_id", {0: 100, 1: 30, 2: 5000}, 4).collect())) for x in (rows, rows.repartition(7, "text")))
    assert one == other and [sum(r[2] == k for r in one) for k in range(3)] == [100, 30, 1333]


def test_sample_of_many_labels(spark):
    """300 labels, a hot row among them: the rows of least hash, as many as asked, from one scan for the counts and one for the rows."""
    rows = spark.range(9000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.concat(F.lit("l"), F.col("id") % 300).alias("k"))
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit(4)), F.lit(1 << 30))
    by = {}
    for r in rows.select("*", u.alias("u")).collect():
        by.setdefault(r["k"], []).append((r["u"], r["doc_id"], r["text"]))
    found = bounded_sample(rows, "k", "doc_id", 7, 4)
    got = sorted((r["k"], r["doc_id"], r["text"]) for r in found.collect())
    assert got == sorted((k, d, t) for k, v in by.items() for _, d, t in sorted(v)[:7]) and len(got) == 2100
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert bounded_sample(rows.limit(0), "k", "doc_id", 7, 4).count() == 0
    assert bounded_sample(rows.withColumn("k", F.lit(None).cast("string")), "k", "doc_id", 7, 4).count() == 0


def test_languages_equal_plain_forward_pass(spark):
    """Byte by byte and filter by filter: the mean over all windows of 96 bytes of a text, the last one filled up with spaces."""
    net = ByteCNN(["de", "en", "zh"], filters=3, seed=6)
    texts = ["A short Text", "und nicht " * 40, "\u4f60\u597d " * 33 + "end", "x", "b" * 96, "c" * 97]
    want = []
    for t in texts:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
        each = []
        for at in range(0, len(raw), 96):
            w = raw[at : at + 96].ljust(96)
            pooled = [max(sum(float(table[j][w[i + j], f]) for j in range(width)) for i in range(96 - width + 1)) for width, table in net.tables.items() for f in range(3)]
            z = [sum(max(0.0, p) * float(net.dense[k, c]) for k, p in enumerate(pooled)) + float(net.bias[c]) for c in range(3)]
            e = np.exp(np.array(z) - max(z))
            each.append(e / e.sum())
        mean = np.mean(each, axis=0)
        want.append((net.labels[int(mean.argmax())], mean.max()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in predict(docs, net).collect())
    assert [g[1] for g in got] == [w[0] for w in want] and np.allclose([g[2] for g in got], [w[1] for w in want], atol=1e-5)


def plain_toxicity(net, text):
    """The largest window probability, word by word and step by step."""
    h, p = net.h, net.p
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        raw = b" " + bytes(c + 32 if 65 <= c <= 90 else c for c in word.encode()) + b" "
        tri = [int(mix(np.array([raw[i - 1] << 16 | raw[i] << 8 | raw[i + 1]], np.uint64))[0]) % TRIGRAMS for i in range(1, len(raw) - 1)]
        return np.concatenate([p["word"][Words([word]).word[0]], sum(p["tri"][i] for i in tri) / np.sqrt(len(tri))]).astype(np.float64)

    def states(k, inputs):
        s, out = np.zeros(h), []
        for x in inputs:
            g, v = x @ p[f"W{k}"] + p[f"b{k}"], s @ p[f"U{k}"]
            z, r = sigmoid(g[:h] + v[:h]), sigmoid(g[h : 2 * h] + v[h : 2 * h])
            s = z * s + (1 - z) * np.tanh(g[2 * h :] + r * v[2 * h :])
            out.append(s)
        return out

    words = text.split()
    starts = [*range(0, len(words) - LENGTH, STRIDE), max(0, len(words) - LENGTH)] if len(words) > LENGTH else [0]
    best = 0.0
    for at in starts:
        seen = words[at : at + LENGTH]
        x = [vector(w) for w in seen] + [np.zeros(2 * net.d)] * (LENGTH - len(seen))
        s = [np.concatenate(fb) for fb in zip(states("f", x), states("b", x[::-1])[::-1])]
        e = np.exp([s[i] @ p["a"] if i < len(seen) else -30.0 for i in range(LENGTH)])
        best = max(best, sigmoid(sum(a * c for a, c in zip(e / e.sum(), s)) @ p["w"] + p["c"][0]))
    return best


def test_toxicity_equals_plain_forward_pass(spark):
    net = ToxicityNet(width=5, hidden=4, seed=8)
    texts = ["You vile RAT", "", " ".join(f"w{i}" for i in range(24)), " ".join(f"v{i % 19}" for i in range(25)), " ".join(f"u{i % 37}" for i in range(150)), "\u00e9t\u00e9 na\u00efve"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["score"] for r in score(docs, net).orderBy("doc_id").collect()]
    assert np.allclose(got, [plain_toxicity(net, t) for t in texts], atol=1e-5) and len({round(x, 4) for x in got}) == len(got)


def test_windows_cover_every_word():
    t = Words([None, "a", " ".join(map(str, range(100))), "b c"])
    assert len(t.word) == 103 and sorted(set(t.index[t.index >= 0].tolist())) == list(range(103))
    assert t.index.shape[1] == LENGTH and (np.diff(t.first_window) > 0).all() and (t.index[0] == -1).all()
    same = Words(["vile x VILE"])
    assert same.word[0] == same.word[2] != same.word[1]


def test_gradients_agree_with_differences():
    net = ToxicityNet(width=3, hidden=2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    t = Words(["one two three four", "five"])
    y = np.array([1.0, 0.0])

    def loss():
        z = net.logits(net.inputs(t).astype(np.float64), t.index)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    g = net.gradients(t, net.inputs(t), t.index, y)
    for name, at in (("w", 1), ("a", 0), ("Uf", (0, 3)), ("Ub", (1, 1)), ("Wf", (2, 4)), ("Wb", (0, 0)), ("bf", 2), ("word", (t.word[1], 0)), ("tri", (t.tri[t.start[0]], 1))):
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = loss()
        net.p[name][at] = old - 1e-3
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - g[name][at]) < 2e-4, name


def test_transcripts_round_trip(spark):
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    lines = raw_log(c)
    model = train(lines.where(F.crc32(F.col("conv_id").cast("string")) % 5 != 0))
    held = lines.where(F.crc32(F.col("conv_id").cast("string")) % 5 == 0)
    turns = recover_turns(held, model)
    truth = held.where("at = 0").select("conv_id", "turn", "at", F.col("role").alias("true"))
    both = truth.join(turns, ["conv_id", "turn", "at"], "left")
    assert both.agg(F.avg(F.coalesce(F.col("true") == F.col("role"), F.lit(False)).cast("int"))).first()[0] > 0.9
    # A conversation decoded in short segments or pieces gives the same turns as in one.
    found = lambda **size: {(r["conv_id"], r["turn"], r["at"], r["role"]) for r in recover_turns(held, model, **size).collect()}
    whole = found()
    assert len(found(span=4, overlap=2) & whole) > 0.97 * len(whole) and len(found(most=5, context=8) & whole) > 0.97 * len(whole)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    n = len(STATES)
    model = RoleHMM({0: 3, 2: 5}, {(i, j): int(c) for i in range(n) for j, c in enumerate(rng.integers(0, 9, n))}, {(int(s), f): int(rng.integers(1, 9)) for s in range(n) for x in ("User: hi?", "so.", "and more", "") for f in features(x)})
    for size in range(1, 6):
        lines = rng.choice(["User: hi?", "so.", "and more", "", "[q] new"], size).tolist()
        scores = {}
        for path in product(range(n), repeat=size):
            p = model.start[path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:]))
            scores[path] = p + sum(e[s] for s, e in zip(path, model.emissions(lines)))
        assert np.isclose(scores[tuple(model.decode(lines))], max(scores.values()))


def recovered(turns):
    """(conv_id, role, text) in order."""
    rows = sorted(turns.collect(), key=lambda r: (r["conv_id"], r["turn"], r["at"], r["nth"]))
    return [(r["conv_id"], r["role"], r["rendered"].removeprefix(f"<|{r['role']}|>\n").removesuffix("\n<|end|>")) for r in rows]


@pytest.fixture(scope="module")
def role_model(spark):
    return train(raw_log(spark.read.parquet(f"{SF}/conversations.parquet")))


RICH = [
    "Note: the answer is 42.\n\nSecond paragraph here.\n\n[1] a reference", "# Heading\n\ntext under it\n\n## Another\nmore", "code:\n\n    def f(x):\n        return {x: 1}\n\n\ndone",
    "- one\n- two\n\n1. first\n2. second", "word: explained\nother: too\n**bold**: so\n<|tag|> in it", "", "\n\nafter blanks", "ends in blanks\n\n", "  indented: yes\n\ttab", "[x] done\n[ ] not done",
]


def test_marked_texts_come_back_as_they_were(spark, role_model):
    """Every style of marker around texts of several paragraphs, headings, lists, code and lines that look like markers."""
    rows = [(conv, t, ("user", "assistant")[t % 2], RICH[(conv + t) % len(RICH)]) for conv in range(12) for t in range(6)]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert recovered(recover_turns(raw_log(c, omit=10**9), role_model)) == [(conv, role, text) for conv, _, role, text in rows]
    assert set(role_model.speakers) == {split_marker(m.rstrip("\n"))[0] for style in STYLES for m in style}


def test_every_line_is_in_one_turn(spark, role_model):
    rows = [(conv, t, ("user", "assistant")[t % 2], RICH[(3 * conv + t) % len(RICH)]) for conv in range(20) for t in range(7)]
    lines = raw_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), omit=3)
    every = [(r["conv_id"], t) for r in lines.orderBy("conv_id", "turn", "at").collect() if (t := role_model.text_of(r["line"])) is not None]
    turns = recover_turns(lines, role_model)
    assert [(conv, x) for conv, _, text in recovered(turns) for x in text.split("\n")] == every
    assert turns.agg(F.sum("n_lines")).first()[0] == lines.count()


def test_turns_equal_plain_assembly(spark, role_model):
    """Held-out logs decoded whole and put together line by line."""
    lines = raw_log(spark.read.parquet(f"{SF}/conversations.parquet")).where("conv_id % 7 = 0")
    logs = {}
    for r in lines.orderBy("conv_id", "turn", "at").collect():
        logs.setdefault(r["conv_id"], []).append(r["line"])
    want = []
    for conv, log in sorted(logs.items()):
        turns = []
        for x, s in zip(log, role_model.decode(log)):
            if STATES[s][1] or not turns:
                turns.append((STATES[s][0], []))
            if (t := role_model.text_of(x)) is not None:
                turns[-1][1].append(t)
        want += [(conv, role, "\n".join(text)) for role, text in turns]
    assert recovered(recover_turns(lines, role_model)) == want


def test_transcript_edges(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], "what is it?" if t % 2 == 0 else "it is so.\nand more") for t in range(40)]
    c = spark.createDataFrame(rows + [(None, 0, "user", "hm?"), (2, None, None, None), (3, 0, "user", "q?"), (3, 0, "user", "q?")], "conv_id long, turn long, role string, text string")
    got = format_chats(c.withColumn("start", F.lit("x"))).collect()
    assert {r["conv_id"] for r in got} == {None, 1, 2, 3} and all(r["rendered"].startswith(f"<|{r['role']}|>\n") for r in got)
    assert format_chats(c.limit(0)).count() == 0
    for style in STYLES:
        assert all(split_marker(m.rstrip("\n") if m.endswith("\n") else m + "text")[0] for m in style)
    assert split_marker("no marker here") == ("", "no marker here")


def test_lines_of_a_very_long_turn_keep_their_order(spark):
    many = "\n".join(f"line {i % 7} of it" for i in range(50_000))
    lines = raw_log(spark.createDataFrame([(1, 0, "user", "hm?"), (1, 1, "assistant", many), (1, 2, "user", "and?")], "conv_id long, turn long, role string, text string"))
    model = train(raw_log(spark.read.parquet(f"{SF}/conversations.parquet")))
    got = recover_turns(lines, model, most=9_000).collect()
    text = "\n".join(x for r in sorted(got, key=lambda r: (r["turn"], r["at"])) for x in r["rendered"].split("\n")[1:-1])
    assert [x.removeprefix("[a] ") for x in text.split("\n") if "line" in x] == many.split("\n") and sum(r["n_lines"] for r in got) == lines.count()
