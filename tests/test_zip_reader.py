"""Zipped shards read in blocks: how far reading runs ahead, and records longer than the first blocks."""

import time
import zipfile

import pytest

from rollcall.sources import zip_shards

COLUMNS = ["a", "b", "c"]


def shard(path, content):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("x.csv", content)
    return str(path)


def rows_of(batches):
    return [tuple(r.values()) for b in batches for r in b.select(COLUMNS).to_pylist()]


def test_reading_does_not_run_far_ahead(tmp_path, monkeypatch):
    line = b'"1";"' + b"x" * 90 + b'";\n'
    path = shard(tmp_path / "S.zip", line * ((120 << 20) // len(line)))
    fetched, read = [0], zipfile.ZipExtFile.read

    def counted(self, n=-1):
        data = read(self, n)
        fetched[0] += len(data)
        return data

    monkeypatch.setattr(zipfile.ZipExtFile, "read", counted)
    batches = zip_shards.shard_batches(path, COLUMNS)
    next(batches)
    before = -1
    while before != fetched[0]:  # until the reader has all that it wants beforehand
        before = fetched[0]
        time.sleep(0.5)
    assert fetched[0] < 48 << 20
    assert sum(b.num_rows for b in batches) > 0


@pytest.mark.parametrize("first", [100, 700, 6000])
def test_a_record_longer_than_the_first_blocks(tmp_path, monkeypatch, first):
    monkeypatch.setattr(zip_shards, "FIRST_BLOCK_BYTES", first)
    wanted = [(str(i), "z\n" * 2000 if i in (70, 150) else f"é;{i}\n", None) for i in range(200)]
    content = "".join(f'"{a}";"{b}";\n' for a, b, _ in wanted).encode("latin-1")
    path = shard(tmp_path / "S.zip", content)
    assert rows_of(zip_shards.shard_batches(path, COLUMNS, block=9000)) == wanted
    with pytest.raises(Exception, match="(?i)straddling|block"):
        list(zip_shards.shard_batches(path, COLUMNS, block=1500))


def test_a_malformed_record_still_stops_the_reading(tmp_path, monkeypatch):
    monkeypatch.setattr(zip_shards, "FIRST_BLOCK_BYTES", 100)
    path = shard(tmp_path / "S.zip", b'"1";"x";"y"\n' * 50 + b'"2";"x"\n')
    with pytest.raises(Exception, match="Expected 3 columns"):
        list(zip_shards.shard_batches(path, COLUMNS, block=9000))
