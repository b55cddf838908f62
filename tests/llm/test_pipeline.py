import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rainlane.llm.mixing import mix, n_words, text_margins
from rainlane.llm.queries import TARGETS
from tests.llm.test_mixing import check_against_brute
from tests.llm.test_packing import check_pieces
from tests.llm.test_shingle_join import brute as near_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """What each stage makes of the sample documents and a few planted ones."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{tables}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    planted = [(9001, "12 34 !!", "en", "src0", 8), (9002, None, None, None, None), (9003, "你好世界" * 30, None, "src0", 120)]
    first = docs.orderBy("doc_id").first()
    planted += [(9004, first.text.replace(" ", "  "), "en", "src0", 1)]
    (docs.unionByName(spark.createDataFrame(planted, SCHEMA))).write.parquet(f"{base}/0")
    frames = [spark.read.parquet(f"{base}/0")]
    for at, (_, function) in enumerate(corpus_pipeline.STAGES, 1):
        function(spark, frames[-1], tables).write.parquet(f"{base}/{at}")
        frames.append(spark.read.parquet(f"{base}/{at}"))
    return frames


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(frame.columns == stages[0].columns for frame in stages[:5])


def test_language_rejects_what_is_in_none(stages):
    assert ids(stages[0]) - ids(stages[1]) == {9001, 9002, 9003}


HUNGARIAN = (
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel "
    "bírván, egymással szemben testvéri szellemben kell hogy viseltessenek. Mindenki, bármely megkülönböztetésre, "
    "nevezetesen fajra, színre, nemre, nyelvre, vallásra, politikai vagy bármely más véleményre való tekintet nélkül "
    "hivatkozhat a jelen Nyilatkozatban kinyilvánított összes jogokra és szabadságokra."
)
ITALIAN = (
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza "
    "e devono agire gli uni verso gli altri in spirito di fratellanza. Ad ogni individuo spettano tutti i diritti e "
    "tutte le libertà enunciate nella presente Dichiarazione, senza distinzione alcuna."
)
ENGLISH = (
    "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and "
    "should act towards one another in a spirit of brotherhood. Everyone is entitled to all the rights and freedoms "
    "set forth in this Declaration, without distinction of any kind."
)
GERMAN = (
    "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und "
    "sollen einander im Geist der Brüderlichkeit begegnen. Jeder hat Anspruch auf die in dieser Erklärung verkündeten "
    "Rechte und Freiheiten ohne irgendeinen Unterschied."
)


def test_language_limit_follows_the_length(spark, tables):
    """Long texts in a Latin-script language that nobody named, or in none, go whatever their
    label; texts in a named one stay, though their words are not the corpus's, and so do the
    short ones of the corpus."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = " ".join("".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(2000))
    planted = [(9001, HUNGARIAN, "en"), (9002, ITALIAN, "es"), (9003, junk, "de"), (9004, ENGLISH, None), (9005, GERMAN, "de")]
    first = docs.orderBy("doc_id").limit(20).collect()
    planted += [(9100 + k, " ".join(r.text.split()[:4]), r.lang) for k, r in enumerate(first)]
    rows = [(key, text, lang, "src0", len(text)) for key, text, lang in planted]
    found = corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame(rows, SCHEMA)), tables)
    assert ids(docs) <= ids(found)
    assert {key for key in ids(found) if key > 9000} == {key for key, *_ in planted} - {9001, 9002, 9003}
    assert [r.lang for r in found.where("doc_id = 9004").collect()] == ["en"]


def test_exact_copies(stages):
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]", "")
    best = stages[1].groupBy(bare.alias("bare")).agg(F.max(F.struct(F.char_length("text"), -F.col("doc_id"))).alias("b"))
    assert ids(stages[2]) == {-r.b[1] for r in best.collect()}
    assert 9004 in ids(stages[2])


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == {key for key, _, least in near_brute(rows, 5, 80) if key == least}


def test_mixing(stages):
    assert ids(stages[4]) == check_against_brute(stages[3], TARGETS)


def test_packing(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    check_pieces(stages[5].withColumnRenamed("doc_id", "id").collect(), texts)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_unlabelled_documents_get_the_language_found(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    english = docs.where("lang = 'en' AND n_chars > 500").orderBy("doc_id").limit(20).withColumn("doc_id", F.col("doc_id") + 10_000)
    found = corpus_pipeline.identify_language(spark, docs.unionByName(english.withColumn("lang", F.lit(None))), tables)
    assert [r.lang for r in found.where("doc_id >= 10000").collect()] == ["en"] * 20
    fifth = found.withColumn("lang", F.when(F.col("doc_id") < 10_000, F.col("lang")).otherwise("it"))
    mixed = mix(fifth, n_words(), text_margins(), TARGETS).where("row.doc_id >= 10000")
    assert mixed.where("probability > 0").count() == 20
