"""Every stage and operator on tables with columns of clashing and odd names, and on empty ones."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orgloom.llm import chat, decontam, fim, jaccard, language, mixing, negatives, neighbours, pii, quality, shards, substrings, tokens
from orgloom.llm.common import table
from orgloom.session import work_dir

#: Names of results and helpers of the operators, and such that a plain reference misreads.
NAMES = (
    "score predicted held_out lang_pred n_words n_hit n_items contaminated items _bad _th th term pos _set _of _root _least _many _n _gone "
    "sid root least node row rows at kept spans base n form output shard slot grown_shard _place stretches copies a.b c`d e` x.y.z"
).split() + ["with space", "passed_3", "UPPER", "é"]


def named(df):
    return df.select("*", *(F.concat(F.lit(f"{n}="), F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("none"))).alias(n) for n in NAMES))


def untouched(df):
    """Whether the extra columns of all rows hold what ``named`` put there."""
    first = df.columns[0]
    return all(r[n] == f"{n}={'none' if r[first] is None else r[first]}" for r in df.collect() for n in NAMES if n in df.columns)


@pytest.fixture(scope="module")
def docs(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(k, f"{text} {k}", "en", "ab"[k % 2], 5) for k in range(12)]
    rows += [(None, None, None, None, None), (None, text, "de", None, 1), (7, "", "en", "a", 0), (7, "the mail is a@b.com", "en", "a", 19)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages(spark, sf_dir, docs, name, stage):
    out = stage(spark, named(docs), sf_dir)
    plain = stage(spark, docs, sf_dir)
    assert set(named(docs).columns) <= set(out.columns) and untouched(out)
    if name != "mix":
        assert out.columns == named(docs).columns
    shared = [c for c in docs.columns]
    assert sorted(map(str, out.select(*shared).collect())) == sorted(map(str, plain.select(*shared).collect()))
    empty = stage(spark, named(docs).limit(0), sf_dir)
    assert empty.collect() == [] and set(named(docs).columns) <= set(empty.columns)


def _vectors(spark):
    rows = [(i, i % 3, [float(i % 5), float(i % 7), 1.0]) for i in range(40)]
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def _turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>"), (None, None, None, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def _bench(spark):
    return spark.createDataFrame([(1, "word1 word2 word3")], "item_id long, text string")


ON_DOCS = {
    "op1": lambda spark, d: decontam.decontaminated(d, _bench(spark)),
    "op1 clean": lambda spark, d: decontam.clean(d, _bench(spark)),
    "op2": lambda spark, d: language.identify(d, language.learn(d)),
    "op4": lambda spark, d: quality.score(d, quality.fit(d, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))),
    "op4 accepted": lambda spark, d: quality.accepted(d, quality.Model(quality.np.zeros(quality.BUCKETS), 1.0)),
    "op5": lambda spark, d: tokens.count_tokens(d, tokens.Automaton(["wo"], ["rd"])),
    "op6": lambda spark, d: pii.find(d, pii.fit(d)),
    "op6 redacted": lambda spark, d: pii.redacted(d, pii.fit(d)),
    "op7": lambda spark, d: jaccard.near_duplicates(d),
    "op7 one of each": lambda spark, d: jaccard.one_of_each(d, 5, 80),
    "op8": lambda spark, d: substrings.deduplicated(d),
    "op10": lambda spark, d: mixing.with_rates(d),
    "op10 mix": lambda spark, d: mixing.mix(d),
    "op11": lambda spark, d: fim.transformed(d),
    "op12": lambda spark, d: shards.write_shards(d, work_dir(spark, "shards")),
}
REPLACED = {"op4": {"score", "predicted"}, "op11": set(fim.ADDED), "op12": set(shards.ADDED)}


@pytest.mark.parametrize("name", ON_DOCS)
def test_operators_on_documents(spark, docs, name):
    made = ON_DOCS[name]
    plain, out = made(spark, docs), made(spark, named(docs))
    new = [c for c in plain.columns if c in out.columns]
    assert new == plain.columns
    assert sorted(map(str, out.select(*(F.col(f"`{c}`") for c in new)).collect())) == sorted(map(str, plain.collect()))
    extra = [c for c in out.columns if c in NAMES and c not in REPLACED.get(name, ()) and c not in plain.columns]
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in extra]
    if extra:
        assert set(extra) >= set(NAMES) - REPLACED.get(name, set()) - set(plain.columns), name
        assert untouched(out.select(*quoted, *(["doc_id"] if "doc_id" in out.columns else [])).select("doc_id", *quoted))
    empty = made(spark, named(docs).limit(0))
    assert empty.collect() == [] and empty.columns == out.columns


def test_operators_on_other_tables(spark):
    x, t = _vectors(spark), _turns(spark)
    extra = named(x.select("vec_id", "label", "embedding"))
    for made in (
        lambda d: neighbours.nearest(neighbours.usable(d), neighbours.usable(d).filter("vec_id % 10 = 0")),
        lambda d: negatives.mine(negatives.usable(d), F.col("vec_id") % 10 == 0),
    ):
        assert sorted(map(str, made(extra).collect())) == sorted(map(str, made(x).collect())) and made(x).count()
        assert made(extra.limit(0)).collect() == []
    talk = lambda d: chat.digests(chat.format_conversations(d))
    assert sorted(map(str, talk(named(t)).collect())) == sorted(map(str, talk(t).collect()))
    assert talk(named(t).limit(0)).collect() == []


def test_the_pipeline_on_real_documents_with_such_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(60)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, named(docs.select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars")])), sf_dir)
        assert untouched(docs)
