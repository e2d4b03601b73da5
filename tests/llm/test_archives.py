"""Archives are bounded in bytes, read as a stream, and give every payload back."""

import glob
import gzip
import hashlib
import random

from shelfmark.llm import warc


def test_files_are_planned_by_bytes():
    per_file = [warc.records_per_file(c) for c in warc.CLASSES]
    assert per_file == [4096, 256, 16, 1, 1]
    # 4,000 pages of 1 MiB are 16 files of 256 MiB at least, whatever wrote them
    assert warc.records_per_file(1 << 20) * (1 << 20) <= warc.FILE_BYTES


def test_sizes_are_split_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "CLASSES", (1000, 5000, 20_000, None))
    rng = random.Random(2)
    texts = ["é" + "".join(rng.choices("ab\r\nW", k=rng.choice([0, 10, 400, 900, 3000, 9000, 70_000]))) for _ in range(150)]
    rows = [(i, f"http://a.net/{i}", texts[i % 120]) for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(pages, str(tmp_path / "a"))
    for file in glob.glob(f"{tmp_path}/a/*.gz"):
        with gzip.open(file) as archive:
            sizes = [len(block.partition(b"\r\n\r\n")[2]) for _, block in warc.parse(archive)]
        assert sum(sizes) <= 20_000 or len(sizes) == 1
    read = warc.read_archives(spark, str(tmp_path / "a"))
    kept = {r.page_id: bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}
    assert all(kept[i] == text for i, _, text in rows if i in kept)
    back = {r.page_id: r for r in warc.resolve(read).collect()}
    assert len(back) == 150
    for i, _, text in rows:
        data = text.encode()
        same = [j for j, _, t in rows if t == text]
        again = len(data) >= 1000 and i < max(same)
        assert (back[i].payload_bytes, back[i].payload_digest, back[i].record_type, back[i].refers_to) == (len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(same) if again else None)
