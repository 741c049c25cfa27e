"""Block-gzip files read in ranges: same lines as the text, whatever the ranges."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from locusloom.sources import blockgzip, genomic
from locusloom.sources.lines import number_lines


def put(path, text: bytes, member=blockgzip.TEXT_PER_MEMBER, end=True):
    pieces = [text[i : i + member] for i in range(0, len(text), member)]
    path.write_bytes(b"".join(blockgzip.packed(p) for p in pieces) + (blockgzip.packed(b"") if end else b""))
    return str(path)


def lines_of(path, split):
    reader = blockgzip.BlockGzipReader([path], split)
    return [(r["line_order"], r["value"]) for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]


def some_text(seed, n, last=b"\n"):
    draw = random.Random(seed)
    rows = [bytes(draw.choices(b"abcdefgh\t", k=draw.choice([0, 1, 20, 300]))) for _ in range(n)]
    rows[n // 2] = bytes(draw.choices(range(97, 123), k=50_000))
    return rows, b"\n".join(rows) + last


@pytest.mark.parametrize("member", [37, 1000, 0xFF00])
@pytest.mark.parametrize("split", [1, 700, 5_000, 1 << 20])
@pytest.mark.parametrize("last", [b"\n", b""])
def test_every_line_once_and_in_order(tmp_path, member, split, last):
    if split == 1:
        rows, text = [b"a", b"", b"bcd", b"e" * 90, b"f"], b"a\n\nbcd\n" + b"e" * 90 + b"\nf" + last
    else:
        rows, text = some_text(member + split, 400, last)
        if not last and not rows[-1]:
            rows = rows[:-1]
    found = lines_of(put(tmp_path / "t.gz", text, member), split)
    assert [v.encode() for _, v in found] == rows
    assert [o for o, _ in found] == sorted({o for o, _ in found})


def test_the_library_of_python_reads_what_is_written(tmp_path):
    rows, text = some_text(5, 300)
    assert gzip.decompress(open(put(tmp_path / "t.gz", text), "rb").read()) == text


def test_heads_inside_packed_text_start_nothing(tmp_path):
    """Members stored as they are carry the bytes of a head in their text."""
    text = b"".join(b"%d " % i + 5 * blockgzip.packed(b"x" * i) + b"\n" for i in range(200))
    path = tmp_path / "t.gz"
    path.write_bytes(b"".join(stored(text[i : i + 3000]) for i in range(0, len(text), 3000)))
    found = [v for _, v in lines_of(str(path), 256)]
    assert found == [line.removesuffix(b"\r").decode("utf-8", "replace") for line in text.removesuffix(b"\n").split(b"\n")]


def stored(text):
    import struct
    import zlib

    deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    extra = b"BC" + struct.pack("<HH", 2, 12 + 6 + len(body) + 8 - 1)
    return b"\x1f\x8b\x08\x04" + struct.pack("<IBBH", 0, 0, 255, 6) + extra + body + struct.pack("<II", zlib.crc32(text), len(text))


def test_ordinary_gzip_is_read_by_its_first_range(tmp_path):
    rows, text = some_text(9, 500)
    path = tmp_path / "t.gz"
    path.write_bytes(gzip.compress(text[:40_000]) + gzip.compress(text[40_000:]))
    assert [v.encode() for _, v in lines_of(str(path), 1000)] == rows


def test_empty_broken_and_missing_files(tmp_path):
    assert lines_of(put(tmp_path / "none.gz", b""), 100) == []
    (tmp_path / "zero.gz").write_bytes(b"")
    assert lines_of(str(tmp_path / "zero.gz"), 100) == []
    whole = open(put(tmp_path / "t.gz", b"abc\n" * 5000, 2000), "rb").read()
    (tmp_path / "cut.gz").write_bytes(whole[: len(whole) // 2 + 7])
    with pytest.raises(ValueError):
        lines_of(str(tmp_path / "cut.gz"), 1 << 20)
    (tmp_path / "plain.gz").write_bytes(gzip.compress(b"abc\n" * 5000)[:-20])
    with pytest.raises(ValueError):
        lines_of(str(tmp_path / "plain.gz"), 1 << 20)
    with pytest.raises(FileNotFoundError):
        lines_of(str(tmp_path / "no.gz"), 100)


def test_one_large_vcf_is_read_by_several_tasks(spark, tmp_path):
    draw = random.Random(3)
    rows = [f"chr{draw.randint(1, 22)}\t{draw.randint(1, 10**8)}\t.\tA\tG\t50\tPASS\tDP=3\tGT:AF\t0/1:0.{i % 10}" for i in range(20_000)]
    path = put(tmp_path / "S1.vcf.gz", ("##header\n" + "\n".join(rows) + "\n").encode())
    found = blockgzip.read_block_lines(spark, path, 32 << 10)
    assert found.rdd.getNumPartitions() > 3
    numbered = number_lines(found).orderBy("line_no").select("line_no", "value").collect()
    assert [tuple(r) for r in numbered] == list(enumerate(["##header", *rows]))
    blocks = genomic.read_vcf(spark, path, block_gzip=True).select("sample_id", "chrom", "pos", "af")
    plain = genomic.read_vcf(spark, path).select("sample_id", "chrom", "pos", "af")
    assert blocks.count() == 20_000 and blocks.exceptAll(plain).isEmpty() and plain.exceptAll(blocks).isEmpty()


def test_written_parts_are_in_order(spark, tmp_path):
    place = str(tmp_path / "out")
    ids = spark.range(50_000).repartitionByRange(4, "id").sortWithinPartitions("id")
    blockgzip.write_block_lines(ids.select(F.concat_ws("\t", F.col("id"), F.md5(F.col("id").cast("string"))).alias("value")), place)
    found = blockgzip.read_block_lines(spark, place, 100_000).orderBy("line_order").select(F.split("value", "\t")[0].cast("long")).collect()
    assert [r[0] for r in found] == list(range(50_000))
    assert spark.read.text(place).count() == 50_000
