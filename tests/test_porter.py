"""Stems of the published rule examples, and of words seen in the stated outputs."""

import pytest
from pyspark.sql import functions as F

from wordloom.functions.porter import porter_stem, stems_udf
from wordloom.operators import frequencies as freq
from wordloom.operators import words
from wordloom.plans.catalogue import stop_patterns

EXAMPLES = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper
feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
references refer people peopl presented present us us apology apolog geology geologi generalizations gener
oscillators oscil yes ye toy toi sayings sai by by ions ion it's it' 1990s 1990
""".split()


@pytest.mark.parametrize("word, stem", list(zip(EXAMPLES[::2], EXAMPLES[1::2])))
def test_examples(word, stem):
    assert porter_stem(word) == stem


def test_arrays_keep_their_shape(spark):
    rows = [(["running", "", "dogs", "running"],), ([],), (None,), (["a"],)]
    found = spark.createDataFrame(rows, "t array<string>").coalesce(1).select(stems_udf()(F.col("t")).alias("s")).collect()
    assert [r["s"] for r in found] == [["run", "", "dog", "run"], [], None, ["a"]]


def test_stripped_then_stemmed(docs):
    corpus = words.normalise(docs("references people "), stop_patterns=stop_patterns())
    assert freq.stemmed(words.token_documents(corpus)).first()["tokens"] == ["referencpeopl"]
    corpus = words.normalise(docs("references, People"), stop_patterns=stop_patterns())
    assert freq.stemmed(words.token_documents(corpus)).first()["tokens"] == ["refer", "peopl"]
