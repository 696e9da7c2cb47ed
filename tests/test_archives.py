"""Reads inside tar archives, against the same files outside."""

import io
import random
import tarfile

import pytest

from clanweave.sources import readers as R
from clanweave.sources.archives import archive_lines, write_archives


def pack(path, members, mode, extra=()):
    with tarfile.open(path, mode) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
        for info in extra:
            tar.addfile(info)
    return str(path)


FASTQ = b"@r1 x\nACGT\n+\n@@@@\n@r2\nAC\n+\nII\n"
FASTA = b">q1\r\nAC\r\nGT\r\n>q2\nA"
WANT = [("one", "q1", "ACGT", 4), ("one", "q2", "A", 1), ("one", "r1", "ACGT", 4), ("one", "r2", "AC", 2)]


@pytest.mark.parametrize(("suffix", "mode"), [("tar", "w"), ("tar.gz", "w:gz"), ("tar.bz2", "w:bz2"), ("tar.xz", "w:xz")])
def test_members(spark, rows, tmp_path, suffix, mode):
    folder = tarfile.TarInfo("d")
    folder.type = tarfile.DIRTYPE
    link = tarfile.TarInfo("again.fastq")
    link.type, link.linkname = tarfile.SYMTYPE, "d/a.fastq"
    p = pack(tmp_path / f"one.{suffix}", [("d/a.fastq", FASTQ), ("empty.fa", b""), ("b.fa", FASTA)], mode, [folder, link])
    assert rows(R.read_archived_reads(spark, p)) == WANT


def test_archive_name_does_not_tell_the_format(spark, rows, tmp_path):
    p = pack(tmp_path / "one.fastq.tar.gz", [("b.fa", FASTA)], "w:gz")
    assert rows(R.read_archived_reads(spark, p)) == WANT[:2]


def test_folder_of_archives_and_empty_ones(spark, rows, tmp_path):
    (tmp_path / "none.tar").write_bytes(b"")
    pack(tmp_path / "bare.tar.gz", [], "w:gz")
    pack(tmp_path / "one 1.tar", [("a.fastq", FASTQ)], "w")
    pack(tmp_path / "two.tar.bz2", [("a.fastq", FASTQ)], "w:bz2")
    got = rows(R.read_archived_reads(spark, str(tmp_path)))
    assert got == [("one 1", "r1", "ACGT", 4), ("one 1", "r2", "AC", 2), ("two", "r1", "ACGT", 4), ("two", "r2", "AC", 2)]


def test_damaged_archive_is_an_error(spark, tmp_path):
    p = tmp_path / "cut.tar"
    pack(p, [("a.fastq", FASTQ * 100)], "w")
    p.write_bytes(p.read_bytes()[:1500])
    with pytest.raises(Exception, match="(?s)ends inside a member|unexpected end of data|ReadError"):
        R.read_archived_reads(spark, str(p)).count()


@pytest.mark.parametrize("piece", [1, 7, 64, 1000])
def test_pieces_of_a_member_hold_every_line_once(spark, tmp_path, piece):
    rng = random.Random(piece)
    texts = {f"m{k}.txt": [("x" * rng.randrange(12)) + str(i) * rng.randrange(2) for i in range(rng.randrange(1, 30))] for k in range(4)}
    members = [(n, "\n".join(t).encode() + b"\n" * (k % 2)) for k, (n, t) in enumerate(texts.items())]
    p = pack(tmp_path / "t.tar", members, "w")
    got = archive_lines(spark, p, piece=piece).orderBy("_file", "_block", "_row").collect()
    for name, data in members:
        want = data.decode().split("\n")
        want = want[:-1] if want[-1] == "" else want
        assert [r["value"] for r in got if r["_file"].endswith("!/" + name)] == want


def test_written_archives(spark, rows, tmp_path):
    d = spark.range(500).selectExpr("concat('@r', id, '\\n', repeat('AC', int(id % 5)), '\\n+\\n', repeat('II', int(id % 5))) as value").repartition(3)
    for kind in ("", "gz", "bz2"):
        paths = write_archives(d, str(tmp_path / f"w{kind}"), "fastq", kind)
        assert paths.count() == 3
        got = rows(R.read_archived_reads(spark, paths), "read_id", "seq")
        assert got == sorted((f"r{i}", "AC" * (i % 5)) for i in range(500))
