import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.functions.lemmas import lemma, lemmatize
from opinara.functions.stemming import porter_stem, stem_words
from opinara.functions.wordlists import STOP_WORDS
from opinara.operators.reviews import (
    clean_text,
    explode_words,
    multiword_filter,
    nonempty_tokens,
)


def one(spark, text, function):
    frame = spark.createDataFrame([(text,)], "t string")
    return frame.select(function(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("Great phone!!! 10/10, a+ buy", ["great", "phone", "a", "buy"]),
        ("i don't like it", ["i", "dont", "like", "it"]),
        ("\n two\tlines\r\nhere ", ["two", "lines", "here"]),
        ("", []),
        (None, []),
        ("!!! 123", []),
    ],
)
def test_tokenize_strip(spark, text, tokens):
    assert one(spark, text, fn.tokenize_strip) == tokens


def test_tokenize_literal_keeps_what_strip_drops(spark):
    assert one(spark, "Great phone!!! 10/10, a+ buy", fn.tokenize_literal) == list("!!!10/10,+")
    assert one(spark, None, fn.tokenize_literal) == []


def test_unknown_tokenizer_mode():
    with pytest.raises(ValueError):
        fn.tokenize(None, "other")


def test_stop_words_are_spark_defaults(spark):
    assert sorted(STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_remove_stopwords_keeps_duplicates_and_order(spark):
    got = one(spark, "the Good and the good bad", lambda t: fn.remove_stopwords(F.split(t, " ")))
    assert got == ["Good", "good", "bad"]


def test_remove_stopwords_equals_the_ml_transformer(spark):
    frame = spark.createDataFrame([("The cat isn't on THE mat cat",)], "t string").select(
        F.split("t", " ").alias("w")
    )
    ml = StopWordsRemover(inputCol="w", outputCol="o").transform(frame).first()["o"]
    assert frame.select(fn.remove_stopwords(F.col("w"))).first()[0] == ml


@pytest.mark.parametrize(
    "text, pieces",
    [
        ("a b", ["a", "b"]),
        ("a  b", ["a", "", "b"]),
        (" a", ["", "a"]),
        ("a ", ["a"]),
        ("", [""]),
        ("  ", []),
    ],
)
def test_split_words(spark, text, pieces):
    assert one(spark, text, fn.split_words) == pieces


def test_word_bag(spark):
    bag = one(spark, "b a  b c b", lambda t: fn.word_bag(fn.split_words(t)))
    assert [(e["word"], e["n"]) for e in bag] == [("a", 1), ("b", 3), ("c", 1)]
    assert one(spark, "", lambda t: fn.word_bag(fn.split_words(t))) == []


# Examples printed with the published algorithm's rules.
PORTER = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop
tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc digitizer digit
conformabli conform vietnamization vietnam operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt communism commun activate activ effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
""".split()


@pytest.mark.parametrize("word, stem", list(zip(PORTER[::2], PORTER[1::2])))
def test_porter_published_examples(word, stem):
    assert porter_stem(word) == stem


def test_porter_short_and_y_words():
    words = ["as", "us", "say", "yes", "dying", "enjoy", "trekked", "s", ""]
    assert [porter_stem(w) for w in words] == [
        "a", "u", "sai", "ye", "dy", "enjoi", "trekk", "", "",
    ]


def test_stem_words_keeps_rows_order_and_empties(spark):
    rows = [(i, ["running", "cats"] * i) for i in range(50)]
    frame = spark.createDataFrame(rows, "i int, w array<string>").repartition(3)
    got = frame.filter("i % 7 <> 3").select("i", stem_words(F.col("w")).alias("s")).collect()
    assert {r["i"]: r["s"] for r in got} == {
        i: ["run", "cat"] * i for i in range(50) if i % 7 != 3
    }


@pytest.mark.parametrize(
    "text, lemmas",
    [
        ("The batteries were dying", "the battery be die"),
        ("can't won't shan't", "can not will not shall not"),
        ("I don't like it.", "i do not like it ."),
        ("it's boxes, glasses & cases!", "it 's box , glass & case !"),
        ("stopped making hoped worked calling", "stop make hope work call"),
        ("children bought 10 phones", "child buy 10 phone"),
        ("this bus is nothing", "this bus be nothing"),
        (None, ""),
    ],
)
def test_lemmatize(spark, text, lemmas):
    assert one(spark, text, lambda t: fn.join_tokens(lemmatize(t))) == lemmas


# Lemmas set by hand, as "lemma: forms".
GOLD = """
provide: provided providing provides
include: included including includes
purchase: purchased purchases purchasing
require: required requires requiring
compare: compared compares comparing
release: released releases releasing
decide: decided decides deciding
change: changed changes changing
add: added adding adds
movie: movies
cookie: cookies
potato: potatoes
tomato: tomatoes
hero: heroes
shoe: shoes
agree: agreed agreeing agrees
guarantee: guaranteed guarantees
die: dying died dies
lie: lying lied lies
tie: tying tied ties
try: tries tried trying
study: studies studied studying
play: plays played playing
use: used uses using
close: closed closes closing
rinse: rinsed rinses
open: opened opening opens
visit: visited visiting
happen: happened happening
travel: travelled travelling travels
call: called calling calls
install: installed installing
create: created creating creates
treat: treated treating
love: loved loving loves
argue: argued arguing
make: making made makes
hope: hoped hoping hopes
hop: hopped hopping
work: worked working works
battery: batteries
box: boxes
glass: glasses
bus: buses
house: houses
cause: causes caused causing
class: classes
watch: watches watched watching
ache: aches ached
headache: headaches
coach: coaches
load: loaded loading
avoid: avoided avoiding
mention: mentioned
promote: promoted promoting
complete: completed completing
focus: focused
panic: panicked panicking
manage: managed managing
engage: engaged
hug: hugged hugging
run: running ran runs
stop: stopped stopping
plan: planned planning
be: am are is was were been being
need: needed needing
precede: preceded
provoke: provoked
look: looked looking
like: liked liking likes
check: checked checking
measure: measured measuring
pour: poured pouring
appear: appeared appearing
fire: fired firing
repair: repaired repairing
ruin: ruined ruining
train: trained training
combine: combined combining
join: joined joining
assume: assumed assuming
contribute: contributed
describe: described describing
compile: compiled
fail: failed failing
schedule: scheduled
test: tested testing
taste: tasted tasting
handle: handled handling
puzzle: puzzled
amaze: amazed amazing
miss: missed missing misses
fix: fixed fixing fixes
show: showed showing
increase: increased increasing
trade: traded
head: headed heading
man: men
woman: women
child: children
foot: feet
tooth: teeth
knife: knives
leaf: leaves
wolf: wolves
person: people
buy: bought buying
think: thought thinking
break: broke broken breaking
write: wrote written writing
drive: drove driven driving
take: took taken taking
go: went gone goes going
have: has had having
do: did does done doing
king: king
nothing: nothing
during: during
this: this
news: news
series: series
always: always
hundred: hundred
physics: physics
feed: fed feed
indeed: indeed
"""


def test_lemmas_set_by_hand():
    pairs = [
        (form, line.split(": ")[0])
        for line in GOLD.strip().splitlines()
        for form in line.split(": ")[1].split()
    ]
    assert len(pairs) > 200
    assert {form: lemma(form) for form, _ in pairs} == dict(pairs)


def test_clean_text_variants(spark):
    frame = spark.createDataFrame([(5.0, "The phones WORKED, really!")], "overall double, reviewText string")
    row = clean_text(frame).first()
    assert row.asDict() == {
        "overall": 5.0,
        "cleaned_reviewText": "phones worked really",
        "cleaned_reviewText_stemmed": "phone work realli",
        "cleaned_reviewText_lemmatized": "the phone work , really !",
    }


def test_clean_text_literal_mode_leaves_no_words(spark):
    frame = spark.createDataFrame([(5.0, "So good! 5/5")], "overall double, reviewText string")
    row = clean_text(frame, mode="literal", variants=("plain",)).first()
    assert row["cleaned_reviewText"] == "! 5 / 5"


def test_multiword_filter(spark):
    frame = spark.createDataFrame([("",), ("one",), ("two words",), (" x",)], "t string")
    assert {r["t"] for r in multiword_filter(frame, "t").collect()} == {"two words", " x"}


def test_explode_words_and_nonempty(spark):
    frame = spark.createDataFrame([(1, "a  b"), (2, ""), (3, "   ")], "i int, text string")
    words = explode_words(frame)
    assert sorted((r["i"], r["word"]) for r in words.collect()) == [
        (1, ""), (1, "a"), (1, "b"), (2, ""),
    ]
    assert nonempty_tokens(words).count() == 2


def test_words_are_mapped_in_slices_of_bounded_size():
    """What is made at once follows the words of a slice, not the rows of a batch."""
    import pyarrow as pa

    from opinara.functions.word_lists import SLICE_WORDS, map_words

    rows = [["Running", "cats"] * (SLICE_WORDS // 8)] * 20 + [[], ["a"] * (2 * SLICE_WORDS), ["cats"]]
    batch = pa.array([["left", "out"], *rows]).slice(1)
    made = list(map_words([batch, batch.slice(0, 0)], str.lower))
    assert [w for part in made for w in part.to_pylist()] == [[w.lower() for w in r] for r in rows]
    assert max(len(part.flatten()) for part in made if len(part) > 1) <= SLICE_WORDS and len(made) > 5
