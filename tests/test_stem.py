"""The stemmer on words of the published examples, and the token job."""

import pyarrow as pa
from pyspark.sql import functions as F

from veracity_prep.functions.stem import _map_distinct, stem_tokens, stem_word

GOLDEN = {
    "caresses": "caress", "flies": "fli", "dies": "die", "mules": "mule", "denied": "deni", "died": "die", "agreed": "agre",
    "owned": "own", "humbled": "humbl", "sized": "size", "meeting": "meet", "stating": "state", "siezing": "siez",
    "itemization": "item", "sensational": "sensat", "traditional": "tradit", "reference": "refer", "colonizer": "colon",
    "plotted": "plot", "ponies": "poni", "cats": "cat", "feed": "feed", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "hopping": "hop", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "enjoy": "enjoy",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formality": "formal", "sensitivity": "sensit", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "communism": "commun",
    "activate": "activ", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "skies": "sky", "dying": "die", "News": "news", "is": "is", "by": "by", "[": "[",
}


def test_golden_words():
    assert {w: stem_word(w) for w in GOLDEN} == GOLDEN


def test_lists_keep_their_shape():
    lists = pa.array([["a", "b"], None, [], ["a", None]])
    assert _map_distinct(lists, str.upper).to_pylist() == [["A", "B"], None, [], ["A", None]]
    assert _map_distinct(lists.slice(1, 3), str.upper).to_pylist() == [None, [], ["A", None]]


def test_token_job(spark):
    df = spark.createDataFrame([(1, ["Running", "dogs"]), (2, []), (3, None)], "k int, w array<string>").repartition(3)
    out = {r["k"]: r["s"] for r in df.select("k", stem_tokens(F.col("w")).alias("s")).collect()}
    assert out == {1: ["run", "dog"], 2: [], 3: None}
