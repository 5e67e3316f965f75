"""Feeds with bytes that do not decode."""

import pytest

from emberlog.session import shared_dir
from emberlog.sources.lines import numbered_lines, read_lines, read_network_csv, stream_lines, stream_network_csv
from emberlog.streaming.ingest import start_fanout

RAW = [b"FG\xff1;23;0;5;vpn", "café � kept".encode(), b"\x1a \x1ar \xc3\x28 \xe2\x82 end", "日本 \x1a�".encode() + b"\x80\xbf", b"plain", b"\xf0\x9f\x98", "é\x85\xa0".encode()]


def _streamed(spark, df, root):
    df.writeStream.format("parquet").option("path", f"{root}-out").option("checkpointLocation", f"{root}-chk").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}-out")


@pytest.fixture
def files(spark):
    root = shared_dir(spark, "feeds")
    with open(f"{root}/a.log", "wb") as f:
        f.write(b"\n".join(RAW))
    return root


def test_lines_leave_out_undecodable_bytes_only(spark, files):
    want = sorted(x.decode("utf-8", "ignore") for x in RAW)
    assert sorted(r.value for r in read_lines(spark, files).collect()) == want
    assert sorted(r.value for r in read_lines(spark, files, with_position=False).collect()) == want
    cut = _streamed(spark, stream_lines(spark, files), files + "-s").collect()
    assert sorted(r.value for r in cut) == want and len({(r.split, r.line_no) for r in cut}) == len(RAW)
    numbered = _streamed(spark, stream_lines(spark, files, positions=True), files + "-p").orderBy("line_no").collect()
    assert [r.value for r in numbered] == [x.decode("utf-8", "ignore") for x in RAW]


def test_csv_fields_leave_out_undecodable_bytes_only(spark):
    root = shared_dir(spark, "feeds-csv")
    rows = [b'05/03/2024 07:09;SW\xff001;dhcpd;"a ""quoted"" \xc3\xa9; \xef\xbf\xbd"', "06/03/2024 07:09;SW002;né;日本".encode() + b"\xe6", b"07/03/2024 07:09;SW003;x"]
    with open(f"{root}/a.csv", "wb") as f:
        f.write(b"\n".join([b"timestamp;device_id;program;msg", *rows]) + b"\n")
    want = [("05/03/2024 07:09", "SW001", "dhcpd", 'a "quoted" é; �'), ("06/03/2024 07:09", "SW002", "né", "日本"), ("07/03/2024 07:09", "SW003", "x", None)]
    assert sorted(map(tuple, read_network_csv(spark, root).collect())) == want
    assert sorted(map(tuple, _streamed(spark, stream_network_csv(spark, root), root + "-s").collect())) == want


def test_lines_of_a_cut_file_have_the_numbers_of_the_whole_one(spark):
    root = shared_dir(spark, "feeds-cut")
    text = {f"f{k}": [f"line {i} of {k} " + "x" * (i % 57) for i in range(400 + 300 * k)] for k in range(4)}
    text["empty"], text["blank"] = [], ["", "", "a", ""]
    for name, lines in text.items():
        with open(f"{root}/{name}.log", "w") as f:
            f.write("\n".join(lines) + ("\n" if lines else ""))
    want = sorted((name, i, line) for name, lines in text.items() for i, line in enumerate(lines))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("3k", "11k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            df = numbered_lines(spark, root)
            got = sorted((r.source.rsplit("/", 1)[1][:-4], r.line_no, r.value) for r in df.collect())
            assert got == want, size
            if size == "3k":
                assert spark.read.text(root).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fanout_without_positions_is_the_same_on_a_replay(spark):
    root = shared_dir(spark, "feeds-fan")
    line = 'FG01;23;0;5;vpn;2024-01-01 00:00:0{};fg;"type=error action=deny srcip=""10.0.0.1"" sentbyte=5";{}'
    spark.createDataFrame([(line.format(i, i),) for i in range(9)], "value string").coalesce(2).write.text(f"{root}/lines")
    seen = []
    for k in range(2):
        start_fanout(spark, f"{root}/lines", f"{root}/topics{k}", f"{root}/chk{k}", available_now=True, positions=False).awaitTermination()
        seen.append(sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(f"{root}/topics{k}").collect()))
    assert seen[0] == seen[1] and len({x for x in seen[0] if x[0] == "fg_raw_all"}) == 9
