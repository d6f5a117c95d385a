import random

import pytest

from brandflow.llm import page_text, url_reputation
from brandflow.llm.queries import ORACLE_SQL, QUERIES


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_is_a_longest_common_subsequence():
    rnd = random.Random(4)
    for _ in range(2000):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(14))] for _ in range(2))
        pairs = page_text.common_lines(a, b)
        assert len(pairs) == longest(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_neighbours_reveal_boilerplate(spark):
    """Pages without an article element: lines that the next page of the host shares go."""
    frame = "<div><p>Home of news</p><p>Today: sunny</p></div>{}<div><p>All rights with us</p></div>"
    rows = [(k, f"http://h.example.com/a/{k}", page(frame.format(f"<div><p>Story {k} begins.</p><p>It ends &amp; <b>st</b>ops {k}.</p></div>"))) for k in range(6)]
    rows.append((9, "http://alone.example.com/x", page("<p>Only page</p>")))
    got = {r["page_id"]: r for r in page_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k]["text"] == f"Story {k} begins. It ends & stops {k}." and got[k]["n_chars"] == len(got[k]["text"])
    assert got[9]["text"] == "Only page"


def test_articles_stay_whole(spark):
    shared = "<p>A passage that both articles quote in full length.</p>"
    rows = [(k, f"http://h.example.com/a/{k}", page(f"<nav><a href=/>Menu</a></nav><article><h1>T{k}</h1>{shared}<p>Own {k}</p><div class='comments'><p>first!</p></div></article><aside>ad</aside>")) for k in range(3)]
    rows += [(10 + k, f"http://h.example.com/b/{k}", page("<article><p>Same article</p></article>")) for k in range(2)]
    got = {r["page_id"]: r["text"] for r in page_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(3):
        assert got[k] == f"T{k} A passage that both articles quote in full length. Own {k}"
    assert got[10] == got[11] == "Same article"


def test_words_of_classes_and_ids_that_do_not_name_boilerplate(spark):
    inside = "<section id='discussion'><p>We discuss {0}.</p></section><h2 id='search'>Search {0}</h2><section id='related-work'><p>Others {0}.</p></section><div class='notice'><p>Shared notice</p></div><div class='notice'><p>Note {0}.</p></div>"
    kept = "We discuss {0}. Search {0} Others {0}. Note {0}."
    rest = "<div class='post-comments'><p>first!</p></div><div class='sidebar'>side</div><div role='search'>find</div>"
    bodies = ["<div class='content no-sidebar'>%s</div>", "<div id='content' class='with-sidebar'>%s</div>", "<article>%s</article>"]
    rows = [(10 * j + k, f"http://h{j}.example.com/{k}", page((body % (inside.format(k) + rest)))) for j, body in enumerate(bodies) for k in range(3)]
    # only the aligned line goes, not another of the same text
    rows += [(90, "http://z.example.com/0", page("<p>Top</p><p>A long own passage of zero.</p><p>Top</p>")), (91, "http://z.example.com/1", page("<p>Top</p><p>A long own passage of one.</p>"))]
    got = {r["page_id"]: r["text"] for r in page_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for j in range(3):
        assert [got[10 * j + k] for k in range(3)] == [kept.format(k) for k in range(3)]
    assert got[90].count("Top") == 1 and got[91] == "A long own passage of one."


def test_odd_pages(spark):
    rows = [
        (1, None, None, "k", "g"),
        (2, "no scheme", "", "k", "g"),
        (3, "http://x.org", "plain < text > &nbsp; and &eacute;", "k", "g"),
        (3, "http://x.org", "plain < text > &nbsp; and &eacute;", "k", "g"),
        (4, "http://x.org/a", "<p>unclosed <b>bold<div class=ad>buy", "k", "g"),
        (None, "http://x.org/b", "<!-- c --><script>var t='<p>';</script><p title='a>b'>x<br>y</p><form>f</form>", "k", "g"),
        (5, "http://y.org/long", "<p>word</p>" * 30_000, "k", "g"),
        (6, "http://y.org/long2", "<p>word</p>" * 30_000 + "<p>end</p>", "k", "g"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string, gone string")
    got = page_text.main_texts(pages).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 8 and by[1]["text"] == "" and by[2]["text"] == "" and by[1]["n_chars"] == 0
    assert by[3]["text"] == "plain < text > and é" and by[4]["text"] == "unclosed bold" and by[None]["text"] == "x y"
    assert by[5]["text"].count("word") == 30_000  # its neighbour is a copy
    assert page_text.main_texts(pages.limit(0)).collect() == []


@pytest.fixture()
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def test_url_query_equals_sql(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["op1_url_filter"](spark, "/root/testdata/sf0.001").select("page_id", "host", "path", "rule", "verdict").collect())
    assert [str(r) for r in got] == [str(r) for r in sorted(duck.execute(ORACLE_SQL["op1_url_filter"]).fetchall())]


HOSTS = "a.b.co.uk c.b.co.uk x.co.uk co.uk uk me.github.io www.me.github.io you.github.io a.example.com b.example.com 10.2.0.1 10.2.0.2 www.xco.uk localhost [::1] a.example.com:8080".split()


def test_url_query_equals_sql_on_hosts_of_all_kinds(spark, tmp_path):
    """Suffixes of several labels, IP hosts, ports; a host with half of the urls, repeated rows and nulls."""
    import duckdb

    rnd = random.Random(8)
    pages, labels = [(0, None, ""), (1, "no scheme", ""), (1, "no scheme", "")], []
    for k in range(2, 900):
        host = HOSTS[0] if k % 2 else rnd.choice(HOSTS)
        pages.append((k, f"http://{host}/{rnd.choice(['en', 'de', 'x'])}/{k}", ""))
        if rnd.random() < 0.7:
            labels.append((k, int(rnd.random() < (0.2 if "b.co" in host or "10.2" in host else 0.9)), 0))
    pages += pages[-3:]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(map(str, map(tuple, QUERIES["op1_url_filter"](spark, str(tmp_path)).select(columns).collect())))
    want = sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL['op1_url_filter']})").fetchall()))
    assert len(set(got)) == 900 and {"'block'", "'allow'"} == {r.rsplit(" ", 1)[1][:-1] for r in got}
    # the SQL gives equal rows once for each pair of them
    assert sorted(set(got)) == sorted(set(want)) and len(got) == len(pages)


def test_urls_of_many_hosts_are_judged_alike(spark, monkeypatch):
    """The join with large hosts told apart gives what the broadcast gives; clashing columns are replaced."""
    from brandflow.operators import lookup

    outcomes = spark.createDataFrame([(f"http://h{k % 7}.example.net/{k}", int(k % 7 < 3)) for k in range(300)], "url string, bad int")
    urls = [(f"http://{'h1' if k % 2 else f'h{k}'}.example.net/{k}", "mine", "mine") for k in range(400)] + [(None, "mine", "mine")] * 2
    df = spark.createDataFrame(urls, "url string, host string, verdict string")
    columns = ["url", "host", "path", "rule", "verdict", "bad_bound"]
    usual = sorted(map(str, url_reputation.judged_urls(df, outcomes).select(columns).collect()))
    real = lookup.lookup_join
    monkeypatch.setattr(url_reputation, "lookup_join", lambda rows, table, key: real(rows, table, key, max_rows=3))
    assert sorted(map(str, url_reputation.judged_urls(df, outcomes).select(columns).collect())) == usual and len(usual) == 402


def test_registered_domains(spark):
    want = {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "x.me.github.io": ("me.github.io", "github.io"),
        "www.xco.uk": ("xco.uk", "uk"), "a.example.com": ("example.com", "com"), "com": ("com", "com"), "10.2.0.1": ("10.2.0.1", "10.2.0.1"), "[::1.2]:80": ("[::1.2]:80", "[::1.2]:80"),
    }
    rows = url_reputation.with_parts(spark.createDataFrame([(f"http://{h}/x",) for h in want], "url string")).collect()
    assert {r["host"]: (r["domain"], r["suffix"]) for r in rows} == want


#: The rules as the contract lists them.
CONTRACT = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"


def test_rules_are_those_of_the_contract(spark, tmp_path):
    """Every rule's word in the query and in its SQL, on the rule's own host, a subdomain, and a path that only begins like the rule's."""
    import duckdb

    pages, want = [], {}
    for line in CONTRACT.split(", "):
        word, rule = line.split(" ")
        for host in ("", "a.b."):
            pages.append((len(pages), f"http://{host}{rule}7", ""))
            want[pages[-1][0]] = (rule, word)
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in QUERIES["op1_url_filter"](spark, str(tmp_path)).collect()}
    sql = {r[0]: (r[1], r[2]) for r in con.execute(f"SELECT page_id, rule, verdict FROM ({ORACLE_SQL['op1_url_filter']})").fetchall()}
    assert got == sql == want


def test_rules_and_reputation(spark):
    outcomes = [(f"http://bad.example.net/{k}", 1) for k in range(60)] + [(f"http://g{j}.example.net/{k}", 0) for j in range(6) for k in range(30)]
    outcomes += [("http://once.example.net/1", 1), (None, 1)]
    outcomes = spark.createDataFrame(outcomes, "url string, bad int")
    urls = ["http://BAD.example.net/x", "http://once.example.net/x", "http://new.example.net/", "https://sub.example.org/es/1?x#y", "http://example.org/en/12", "http://a.org?q=/es/", "http://x.com/fr/a", "http://x.com/de/a", "http://com/de/", "http://xcom/de/", None, "no scheme", "a://b://c/d"]
    df = spark.createDataFrame([(u, "s", "d") for u in urls], "url string, suffix_x string, mean string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judged_urls(df, outcomes).collect()}
    assert got["http://BAD.example.net/x"] == ("bad.example.net", "/x", None, "block")
    assert got["http://once.example.net/x"][3] == "allow"  # one bad page proves little
    assert got["https://sub.example.org/es/1?x#y"] == ("sub.example.org", "/es/1", "example.org/es/", "block")
    assert got["http://example.org/en/12"][2:] == ("example.org/en/1", "block")
    assert got["http://a.org?q=/es/"][:3] == ("a.org", "", None)
    assert got["http://x.com/fr/a"][2:] == ("com/fr/", "allow") and got["http://x.com/de/a"][3] == got["http://com/de/"][3] == "block"
    assert got["http://xcom/de/"][2] is None
    assert got[None][:2] == got["no scheme"][:2] == ("", "") and got["a://b://c/d"][:2] == ("b:", "//c/d")
    none = url_reputation.judged_urls(df, outcomes.limit(0)).where("rule is null").collect()
    assert {r["verdict"] for r in none} == {"allow"}
    assert url_reputation.judged_urls(df.limit(0), outcomes).collect() == []
