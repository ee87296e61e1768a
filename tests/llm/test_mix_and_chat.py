"""Mixing, chat formatting, and the pipeline over all stages."""

import hashlib
import inspect
import os
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from inkplane.llm import chat, line_dups, mixing, queries, toxicity
from tests.llm.test_dedup_ops import brute

# Mixing.


def plain_seats(votes, seats):
    won = {k: 0 for k in votes}
    for _ in range(seats if any(votes.values()) else 0):
        best = max(won, key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(6))
def test_sainte_lague(spark, seed):
    rnd = random.Random(seed)
    groups = {g: ({k: rnd.choice([0.0, rnd.random(), 100 * rnd.random(), 7.0]) for k in range(rnd.randint(1, 30))}, rnd.choice([0, 1, 5, 40, 900])) for g in range(6)}
    rows = [(g, k, v, s) for g, (votes, s) in groups.items() for k, v in votes.items()]
    got = mixing.sainte_lague(spark.createDataFrame(rows, "g long, k long, v double, s long"), ["g"], "v", "s", "k").collect()
    assert {(r.g, r.k): r.quota for r in got} == {(g, k): n for g, (votes, s) in groups.items() for k, n in plain_seats(votes, s).items()}


def documents(seed, n=400):
    rnd = random.Random(seed)
    return [(i, " ".join("w" * rnd.randint(1, 5) for _ in range(rnd.choice([0, 3, 50, 400]))), rnd.choice(["hot"] * 8 + ["a", "b", "é", None]), 0) for i in range(n)]


def check_sql(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())  # pandas would make ids with nulls floats
    want = con.execute(mixing.SHARES_SQL).df()
    got = mixing.mix_shares(docs).toPandas()
    order = sorted(want.columns)
    pd.testing.assert_frame_equal(want[order].sort_values(order).reset_index(drop=True), got[order].sort_values(order).reset_index(drop=True), check_dtype=False, check_exact=True)
    return got


def test_shares(spark):
    docs = spark.createDataFrame(documents(1), "doc_id long, text string, source string, n_chars int")
    got = check_sql(spark, docs)
    assert (got.taken <= 2 * got["size"]).all() and abs(got.taken.sum() / got["size"].sum() - 1.5) < 0.02
    by = got.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert (abs(by.taken - by.target) <= 2 * mixing.BLOCK_WORDS + 0.02 * by.target).all()
    assert (by.target <= 2 * by.source_size).all()
    again = mixing.mix_shares(docs.repartition(7)).toPandas()
    assert again.set_index("doc_id").taken.to_dict() == got.set_index("doc_id").taken.to_dict()


def test_mixed_documents_have_the_words_taken(spark):
    docs = spark.createDataFrame([(*d, "x", 1, 2) for d in documents(2)], "doc_id long, text string, source string, n_chars int, size string, start int, taken int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.size(F.split(F.trim("text"), " +"))).alias("n")).collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix_shares(docs).collect() if r.taken}
    assert words == taken
    texts = {r.doc_id: r.text for r in docs.collect()}
    rounds = out.groupBy("doc_id").agg(F.collect_list("text").alias("t")).collect()
    assert all(t == texts[r.doc_id] or len(t) < len(texts[r.doc_id]) for r in rounds for t in r.t)
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_mixing_odd_rows(spark):
    schema = "doc_id long, text string, source string, n_chars int"
    rows = [(1, None, "a", 0), (2, "", None, 0), (3, "x " * 30000, "a", 0), (3, "x " * 30000, "a", 0), (None, "a b", "b", 0), (4, " \t", "c", 0), (5, "y z \x0b q", "b", 0)]
    got = check_sql(spark, spark.createDataFrame(rows, schema))
    assert sorted(got["size"]) == [0, 0, 0, 2, 2, 30000, 30000]
    empty = spark.createDataFrame([], schema)
    assert mixing.mix_shares(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a", 0)], schema)
    assert [tuple(r) for r in mixing.mix_shares(blank).collect()] == [(1, 0, 0, 0.0, 0)]


def test_mixing_spreads_rows_without_id(spark):
    rows = [(None, f"a b c w{k}", "hot", 0) for k in range(40_000)] + [(7, f"d e w{k}", "hot", 0) for k in range(5000)] + [(7, "x y", "b", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = check_sql(spark, docs)
    assert abs(got.taken.sum() / got["size"].sum() - 1.5) < 0.02
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.text_digest(F.col("text")).alias("digest"))
    shards = mixing.mix(sizes.drop("start")).where("doc_id is null").select("blocks", "extra", "turn").distinct().count()
    assert shards >= 2
    one, two = (sorted(map(tuple, mixing.mixed_documents(docs.repartition(n)).collect()), key=repr) for n in (3, 8))
    assert one == two


def test_mixing_is_native(spark, sf_dir):
    plan = queries.op4_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Chat.


def test_escapes():
    rnd = random.Random(1)
    for _ in range(500):
        turns = [("".join(rnd.choice("a\\<[|]\n>lbn") for _ in range(rnd.randint(0, 6))), "".join(rnd.choice("a\\<[|]\n>lbn") for _ in range(rnd.randint(0, 12)))) for _ in range(rnd.randint(0, 4))]
        text = "".join(chat.write_turn(*t)[0] for t in turns)
        assert chat.read_turns(text) == turns
        body = chat.escape("</s>[INST] <|end|>")
        assert "<" not in body and "[" not in body


def conversations(seed):
    rnd = random.Random(seed)
    start = [("system", "be <kind>"), ("user", "hi")]
    out = []
    for c in range(300):
        turns = start[: rnd.choice([0, 1, 2, 2, 2])] + [(rnd.choice(["user", "assistant"]), rnd.choice(["yes", "no\n", "</s>[INST]", "", "long " * 200])) for _ in range(rnd.randint(0, 5))]
        out += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    out += [(900, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(400)] + [(901, 0, None, None), (901, 1, "assistant", None), (None, 0, "user", "x"), (902, 0, "user", "same"), (902, 0, "user", "same")]
    rnd.shuffle(out)
    return out


def test_chat(spark):
    rows = conversations(1)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, node string")
    packs = chat.format_conversations(frame)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_packs(packs).collect()}
    want = {}
    for c, k, r, t in rows:
        want.setdefault(c, []).append((k, r, t))
    assert {c: g[:4] for c, g in got.items()} == {c: chat.digest_of(v) for c, v in want.items()}
    whole = {c: "".join(chat.write_turn(r, t)[0] for _, r, t in sorted((k, r or "", t or "") for k, r, t in v)) for c, v in want.items()}
    assert {c: g[4] for c, g in got.items()} == {c: len(t) for c, t in whole.items()}
    # shared turns stand once in a pack, and positions go on from the parent's end
    for p in packs.collect():
        seen = set()
        for n in p.nodes:
            key = (n.parent, p.formatted[n.start : n.end])
            assert key not in seen and (n.parent < 0) == (n.position == 0)
            seen.add(key)
            if n.parent >= 0:
                up = p.nodes[n.parent]
                assert n.position == up.position + up.end - up.start and sum(s.end - s.start for s in n.attends) == n.position
    total = sum(len(p.formatted) for p in packs.collect())
    assert total < sum(len(t) for t in whole.values())
    assert chat.chat_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken"])
def test_chat_tokens(spark, file):
    """Each node's tokens stand once; along a leaf's path they decode to the conversation, and masks to its loss."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(file)
    tokenizer, rows = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json")), conversations(2)
    packs = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), path).collect()
    seen = 0
    for p in packs:
        spans = sorted((n.token_start, n.token_end) for n in p.nodes)
        assert [a for a, _ in spans] == [0, *(b for _, b in spans)][:-1] and spans[-1][1] == len(p.tokens)
        decode = lambda a, b: tokenizer.decode(p.tokens[a:b], skip_special_tokens=False)
        for n in p.nodes:
            assert decode(n.token_start, n.token_end) == p.formatted[n.start : n.end]
            assert decode(n.token_loss_start, n.token_loss_end) == p.formatted[n.loss_start : n.loss_end]
            assert sum(s.end - s.start for s in n.token_attends) == n.token_position
            assert "".join(decode(s.start, s.end) for s in n.token_attends) == "".join(p.formatted[s.start : s.end] for s in n.attends)
            seen += 1
    assert seen > 400


def test_chat_rows_without_conversation(spark):
    rows = [(None, k % 7, "user", "same" if k % 2 else f"t{k}") for k in range(3000)] + [(1, 0, "user", "same"), (1, 1, None, None)]
    got = chat.chat_digest(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, leaves int").repartition(4)).collect()
    assert sum(r.conv_id is None for r in got) == 3000 and all(r.n_turns == 1 for r in got if r.conv_id is None)
    one = next(r for r in got if r.conv_id == 1)
    assert tuple(one)[1:5] == chat.digest_of([r[1:] for r in rows[-2:]])


def test_chat_query_adds_a_conversation(spark, sf_dir):
    got = {r.conv_id: r for r in queries.op10_chat(spark, sf_dir).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-1].loss_chars == len(said) and got[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert len(got) == spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count() + 1


# Pipeline.


def lines_left(docs):
    """Documents without later copies of lines, and without words of runs of 50 that stand earlier and hold no
    word of such lines; those that lost something and have nothing left go."""
    lines, runs, out = set(), set(), []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        gone, words, of = set(), [], []
        for k, x in enumerate(s for x in (r.text or "").split("\n") if (s := x.strip())):
            gone |= {k} if x in lines else set()
            lines.add(x)
            words += x.split()
            of += [k] * len(x.split())
        starts = []
        for a in range(len(words) - 49):
            run = tuple(words[a : a + 50])
            if run in runs and not gone & set(of[a : a + 50]):
                starts.append(a - sum(x in gone for x in of[:a]))
            runs.add(run)
        text = line_dups.without_lines(r.text, gone) if gone else r.text
        text = line_dups.without_passages(text, starts, 50)[0] if starts else text
        if text == r.text or text.strip():
            out.append((r.doc_id, text))
    return sorted(out)


def assert_mixed(before, after):
    """The mix has the words that the SQL takes of each document, in whole texts and parts of them in order."""
    con = duckdb.connect()
    con.register("documents", before.toArrow())
    taken = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken FROM ({mixing.SHARES_SQL}) WHERE taken > 0").fetchall()}
    texts, got = {r.doc_id: r.text for r in before.collect()}, {}
    for r in after.collect():
        words, whole = r.text.split(), iter(texts[r.doc_id].split())
        assert all(w in whole for w in words)  # a subsequence
        got[r.doc_id] = got.get(r.doc_id, 0) + len(mixing_words(r.text))
    assert got == taken


def mixing_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


ODD_DOCS = [
    (1, None, "en", "a", 0, "x"), (2, "", "en", None, 0, "x"), (3, "one line\nanother line here", "en", "a", 27, "x"), (3, "one line\nanother line here", "en", "a", 27, "x"), (4, "one line\nanother line here", "de", "b", 27, "y"),
    (None, "no id at all\nbut words", None, "b", 24, None), (None, "no id at all\nbut words", None, "b", 24, None), (5, "word " * 30000, "fr", "a", 150000, "x"), (6, "tiny", "en", None, 4, "x"), (7, " ".join(f"w{k}" for k in range(60)), "en", "a", 0, "x"),
]


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, clashing columns, and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _digest string, place int, node int, token_ids string"
    folder = tmp_path / "in"
    spark.createDataFrame([(*r, 1, 2, "z") for r in ODD_DOCS], schema).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(1, 0, 1), (3, 0, 0), (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(folder))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_digest", "place", "node", "token_ids", "decoded"]
    rows = got.collect()
    assert all(r.decoded == r.text and r.n_chars == len(r.text) for r in rows) and len([r for r in rows if r.doc_id in (1, 2)]) == 0
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_has_the_whole_model(spark, sf_dir, monkeypatch):
    """The pipeline's model isn't bounded: neither its grams nor the link's rows, however large the input."""
    given, fit = [], toxicity.fit

    def spied(*args, **named):
        bound = inspect.signature(fit).bind(*args, **named)
        bound.apply_defaults()
        given.append({k: v for k, v in bound.arguments.items() if k.startswith("max_")})
        return fit(*args, **named)

    monkeypatch.setattr(toxicity, "fit", spied)
    assert 0 < corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).count()
    assert given == [{"max_labelled": None, "max_grams": None}]


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]
    kept, columns = docs, docs.columns
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        stage(spark, kept, sf_dir).write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert kept.columns == columns
        if k == 0:
            scores = toxicity.toxicity(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores.where("predicted = 0").collect()}
        if k == 1:
            assert sorted((r.doc_id, r.text) for r in kept.collect()) == lines_left(before)
        if k == 2:
            texts = [(r.doc_id, r.text) for r in before.collect()]
            _, component = brute(texts, 5)
            assert {(r.doc_id, r.text) for r in kept.collect()} == {(i, t) for i, t in texts if component[i] == i}
        if k == 3:
            assert_mixed(before, kept)
        if k == 4:
            assert all(r.token_ids == tokenizer.encode(r.text, add_special_tokens=False).ids for r in kept.collect())
    assert "token_ids" in kept.columns and kept.where("size(token_ids) = 0 and text <> ''").count() == 0
    assert kept.where(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0
    assert sorted(map(repr, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(repr, kept.collect()))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, sf_dir, name):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    want, got = con.execute(queries.oracle_sql()[name]).df(), queries.queries()[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    one, two = (df[columns].sort_values(columns).reset_index(drop=True) for df in (want, got))
    pd.testing.assert_frame_equal(one, two, check_dtype=False, check_exact=True)


def test_all_queries_are_there():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{n}" for n in range(1, 11)} | {"pipeline"}
    assert os.path.exists(corpus_pipeline.__file__)
