"""Archives whose files are not those of their manifest."""

import gzip

import pytest
from pyspark.sql import functions as F

from assaymill.llm import sentencepiece_codec, warc
from assaymill.llm.queries import PIECE_MODEL


@pytest.mark.parametrize("damage", ["cut", "doubled", "changed", "gone"])
def test_damaged_files_are_errors(spark, tmp_path, damage):
    rows = spark.range(50).select(
        F.col("id").alias("page_id"), F.lit("http://h/").alias("url"), F.repeat(F.col("id").cast("string"), 90).alias("html")
    )
    folder = tmp_path / "archive"
    warc.write_archive(rows, f"file://{folder}")
    assert warc.read_archive(spark, f"file://{folder}").count() == 50
    file = next(folder.glob("part-*.warc.gz"))
    data = file.read_bytes()
    last = data.rindex(b"\x1f\x8b\x08")  # the start of the last member
    if damage == "gone":
        file.unlink()
    else:
        member = gzip.compress(gzip.decompress(data[last:]), 1, mtime=1)
        file.write_bytes({"cut": data[:last], "doubled": data + data[last:], "changed": data[:last] + member}[damage])
    with pytest.raises(Exception, match="manifest|No such file|not exist|FileNotFound"):
        warc.read_archive(spark, f"file://{folder}").count()


def test_whole_texts_decode_and_agree_with_the_original(spark):
    texts = ["", " ", "a  b", "  lead and tail  ", "naïve 日本 \U0001f600 x\ny\tz", "▁mark", "word " * 3000, "́a"]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.model_bytes(PIECE_MODEL), threads=2)
    for text, (ids, parity, same) in zip(texts, codec.encode(texts)):
        whole = codec.original.encode(text)
        assert parity == (list(ids) == whole), text
        assert same == (codec.decode([ids])[0] == text), text
