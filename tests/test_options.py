import datetime as dt

from pyspark.sql import functions as F

from crawlspark.functions import options as O
from crawlspark.operators import seeds as Q
from crawlspark.plans import jobs as J
from crawlspark.sources.text import read_seed_lines

X = F.col("x")
# -fu and -fa are no options, so they are reported
SAMPLE = (
    "https://paper.example/today\t-i pt45m -p 77 -d 2 -fd main -e post -ed #text -Fheadline=h2 -Fbody=.text%i "
    "-fu x -c replies -cd #replies -ci li -FFwho=.who -fa 3 -FFtime=time"
)


def test_split(ask):
    lines = ["http://a.com -p 1", "http://a.com\t-p 1", "  http://a.com  ", "", None]
    assert ask(lines, O.seed_url(X)) == ["http://a.com"] * 3 + ["", ""]
    assert ask(lines, O.seed_args(X)) == ["-p 1", "-p 1", "", "", ""]


def test_options(ask):
    full, empty, bad = ask([SAMPLE.split("\t")[1], "", "-p x -amin 7 --anchor-max-length 9 -i soon"], O.parse_options(X))
    assert (full.interval_s, full.priority, full.depth, full.entity, full.collection_item) == (2700, 77, 2, "post", "li")
    assert full.bad_options == "-fu -fa"
    defaults = (3600, 0, 1, 5, 50, 10, 200, "body", "body", None, "")
    names = "interval_s priority depth amin amax umin umax follow_dom entity_dom entity bad_options".split()
    assert tuple(empty[n] for n in names) == defaults
    assert (bad.priority, bad.amin, bad.amax, bad.interval_s) == (0, 7, 9, 3600)


def test_defaults_equal_an_empty_line(ask):
    one, two = ask([""], O.parse_options(X)), ask([""], O.default_options())
    assert one[0].asDict() == two[0].asDict()


def test_extractors(ask):
    args = SAMPLE.split("\t")[1] + " -Fheadline=again"
    assert ask([args], O.field_extractors(X, "F")) == [{"headline": "h2", "body": ".text i"}]
    assert ask([args], O.field_extractors(X, "FF")) == [{"who": ".who", "time": "time"}]
    assert ask([""], O.field_extractors(X, "F")) == [{}]


def test_options_line(spark):
    lines = spark.createDataFrame([("http://a.com -w b^1.25,a -p 3 -Fz=1 -Fa=2 -FFq=3 -i P1DT1M",)], "line string")
    s = Q.parse_seeds(lines)
    line = s.select(O.options_line(F.col("url"), F.col("opts"), F.col("fields"), F.col("sub_fields"))).first()[0]
    assert line == (
        "http://a.com -log 0 -i PT24H1M -p 3 -s 0 -d 1 -z UTC -fd body -w a^1,b^1.2 "
        "-amin 5 -amax 50 -umin 10 -umax 200 -ed body -Fa=2 -Fz=1 -FFq=3"
    )


def test_negative_durations_print_readably(ask):
    seconds = [-5, -3665, 0, 5, 90061]
    printed = ask([str(n) for n in seconds], O.iso_duration(X.cast("bigint")))
    assert printed == ["-PT5S", "-PT1H1M5S", "PT0S", "PT5S", "PT25H1M1S"] and ask(printed, O.duration_seconds(X)) == seconds


def test_durations(ask):
    texts = ["pt1s", "30d", "10m", "60s", "2h", "PT1H30M", "P2D", "P1DT1S", "-PT5S", "PT1.5S", "P", "x", "", "5", None]
    want = [1, 2592000, 600, 60, 7200, 5400, 172800, 86401, -5, 1, None, None, None, None, None]
    assert ask(texts, O.duration_seconds(X)) == want


def test_instants(ask):
    epoch = dt.datetime(1970, 1, 1)
    got = ask(["2024-01-05T10:00:00Z", "2024-01-05T10:00:00.250Z", "2024-13-01T00:00:00Z", "soon", None], O.instant(X))
    assert got == [dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10, 0, 0, 250000), epoch, epoch, epoch]


def test_int_pair(ask):
    assert [tuple(p) for p in ask(["8,40", "8", "a,1"], O.int_pair(X))] == [(8, 40), (8, None), (None, 1)]


def test_keywords(ask):
    texts = ["a^2,b", "a^2, a^3 ,b^x", "^2,c^,d^1.5", "a,,b", "a,b,,"]
    got = [{k.keyword: k.weight for k in row} for row in ask(texts, O.weighted_keywords(X))]
    assert got == [{"a": 2.0, "b": 1.0}, {"a": 3.0, "b": 1.0}, {"^2": 1.0, "c^": 1.0, "d": 1.5}, {"a": 1.0, "": 1.0, "b": 1.0}, {"a": 1.0, "b": 1.0}]
    assert ask(["b^0.25,a^2,c^0.35"], O.format_keywords(O.weighted_keywords(X))) == ["a^2,b^0.2,c^0.4"]


def test_seed_file_with_continuations(spark, tmp_path):
    (tmp_path / "s.txt").write_text("http://a.com\t-p 1 \\\n   -e article \\\n  -d 2\n\nhttp://b.com\n")
    lines = [r.line for r in read_seed_lines(spark, str(tmp_path / "s.txt"), continued=True).collect()]
    assert [x for x in lines if x] == ["http://a.com\t-p 1 -e article -d 2", "http://b.com"]
    assert read_seed_lines(spark, str(tmp_path / "s.txt")).count() == 5


def test_inject_drops_bad_lines_and_is_idempotent(spark):
    lines = spark.createDataFrame([(SAMPLE,), ("",), ("  ",), ("not-a-url -p 5",), ("http://b.com",), ("http://b.com -p 2",)], "line string")
    now = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    rows = {r.url: r for r in J.inject(None, lines, now).collect()}
    assert set(rows) == {"https://paper.example/today", "http://b.com"}
    seed = rows["https://paper.example/today"]
    assert (seed.fetch_priority, seed.fetch_interval_s, seed.mark_inject, seed.status) == (77, 2700, "Y", "UNFETCHED")
    again = J.inject(J.inject(None, lines, now), lines, now)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, J.inject(None, lines, now).collect()))
