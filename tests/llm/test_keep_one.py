"""One row of each near-duplicate group stays, also where ids repeat or are missing."""

from assaymill.llm import simhash

A = "one text about rivers and the boats that go on them in spring"
B = "quite another thing: seven lamps stood in a row behind the old mill"
C = "a third story tells of bread, salt and a long winter in the hills"


def test_groups_are_of_rows_not_of_ids(spark):
    rows = [(5, A), (7, A), (5, B), (3, B), (9, C), (9, A + " x y z w v u t"), (None, C), (None, B), (None, "no id " + C[::-1]), (None, "no id " + C[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(5, A), (3, B), (9, C), (9, rows[5][1]), (None, rows[8][1])], key=str)
