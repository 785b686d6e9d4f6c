"""What the pipeline's stages must not lose."""

import numpy as np
import pyarrow as pa

from keelstone.llm import langid, simhash

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
UNLIKE = "a wholly different document about ships and harbours that nobody else has written down before today"


def test_rows_without_or_with_repeated_ids_are_kept_once_a_component(spark):
    other = "the third kind of text speaks of rivers and bridges and mills and of the people who live there"
    last = "finally some words on stars and planets and the long way of light through the empty dark of space"
    rows = [(3, LONG, "x"), (7, UNLIKE, "x"), (7, LONG, "x"), (None, other, "x"), (None, last, "x"), (None, last, "y"), (None, UNLIKE, "x"), (9, "unique text of this one only " + other[::-1], "x"), (9, "unique text of this one only " + other[::-1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(df).collect()), key=str)
    assert kept == sorted([(3, LONG), (7, UNLIKE), (None, other), (None, last), (9, rows[-1][1])], key=str)
    assert simhash.one_of_each(df).dtypes == df.dtypes
    first = [simhash.one_of_each(df.repartition(n).where("doc_id is null")).where("text like 'finally%'").collect() for n in (1, 5)]
    assert first[0] == first[1] and len(first[0]) == 1


FOREIGN = [
    "La casa era molto grande e il giardino pieno di fiori che la nonna aveva piantato molti anni prima della guerra, quando tutti vivevano ancora insieme nel piccolo paese",
    "Dom był bardzo duży, a ogród pełen kwiatów, które babcia zasadziła wiele lat przed wojną, kiedy wszyscy mieszkali jeszcze razem w małej wiosce nad rzeką",
    "Talo oli hyvin suuri ja puutarha täynnä kukkia, jotka isoäiti oli istuttanut monta vuotta ennen sotaa, kun kaikki asuivat vielä yhdessä pienessä kylässä",
    "Ev çok büyüktü ve bahçe büyükannenin savaştan yıllar önce diktiği çiçeklerle doluydu, herkes hala küçük köyde birlikte yaşıyordu ve mutluydu",
    "Дом был очень большой, и сад был полон цветов, которые бабушка посадила за много лет до войны, когда все ещё жили вместе",
]
CLEAN = ["Avec.", "The house was very old.", "Das Haus ist sehr alt und steht in der Stadt.", "La maison est dans la ville et elle est grande.", "The man went to the house and said that he would come again in the morning with his brother."]


def test_foreign_and_random_texts_are_rejected_and_short_clean_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "text")
    model = langid.fit(docs.where(~langid.held_out("doc_id", 4, 2)))
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in (150, 600, 2000) for _ in range(20)]
    far = lambda texts: model.nearest(pa.array(texts))[2]
    assert far(FOREIGN).all() and far(noise).mean() > 0.9 and not far(CLEAN).any()
    found = langid.identify(docs.where(langid.held_out("doc_id", 4, 2)), model)
    rejected, n = found.where("rejected").count(), found.count()
    print("rejected", rejected, "of", n, "noise", far(noise).reshape(3, -1).mean(axis=1), "limits", model.reach.round(2).tolist())
    assert rejected <= 0.01 * n
