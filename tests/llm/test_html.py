from tests.llm.samples import words
from tidedesk.llm.html import decode, features, hint_margins, main_texts, parse

HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"


def plain(n):
    """A page like most, and its main text."""
    title, body = words(n, 6), [words(100 * n + k, 30 + k) for k in range(4)]
    html = (
        f"{HEAD}<nav><ul><li><a href='/a'>{words(n, 1)}</a></li><li><a href='/b'>more</a></li></ul></nav>"
        f"<div class='ad'>{words(n + 1, 8)}</div><article><h1>{title}</h1>"
        + "".join(f"<p>{b}</p>" for b in body)
        + f"</article><div class=\"comments\"><p>{words(n + 2, 12)}</p></div><footer>&copy; {words(n + 3, 4)}</footer></body></html>"
    )
    return html, "\n".join([title, *body])


def pages(spark, rows):
    return spark.createDataFrame([(n, f"http://h/{n}", h, "x") for n, h in rows], "page_id long, url string, html string, text string")


def blocks(html):
    return [t for _, t in parse(html).blocks]


def test_parse():
    assert blocks("<p>a<p>b <b>c<br>d</b> &amp;&#233;&lt;x&gt;\n\t e<li>f<li>g") == ["a", "b c d &é<x> e", "f", "g"]
    assert blocks("x<!-- <p>no</p> -->y<script>if(a<b){'</p>'}</script>z") == ["xy z"]
    assert blocks("<table><tr><td>a<td>b<tr><th>c</table>d") == ["a", "b", "c", "d"]
    assert blocks("a < b <p class='x>y' id=\"q\">c</p> <3 d<p") == ["a < b", "c", "<3 d"]
    assert blocks("<p title=\"open>a</p>b") == ["a", "b"] or blocks("<p title=\"open>a</p>b") == []
    assert blocks("") == [] and blocks("just text") == ["just text"] and blocks("<<<>>>") == ["<<<>>>"]
    assert blocks("a<style>") == ["a"] and blocks("</p></div>a</b>") == ["a"]


def test_open_elements_cost_no_text():
    assert blocks('<article><p>One <svg class="i"/> two.</p><p>Three.</p></article>') == ["One two.", "Three."]
    assert blocks("<p>a <svg><svg>x</svg><path/></svg> b</p><p>c</p>") == ["a b", "c"]
    assert blocks("<p>a <svg><path> b</p><p>c</p>") == ["a", "c"]
    assert blocks("<p>a</p><button>Open<p>b</p><p>c</p>") == ["a", "b", "c"]
    assert blocks("<p>a</p><button>Open<p>b</p><button>x</button><p>c</p>") == ["a", "b", "c"]
    assert blocks("<p>a</p><button><div>Buy</div></button><p>b</p>") == ["a", "b"]
    assert blocks("<p>a<select><option>x</p><p>b</p>") == ["a", "b"]
    assert blocks("<p>a<select><option>x</select> y</p><p>b</p>") == ["a y", "b"]
    assert blocks("<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math></p>") == ["E = mc2"]
    assert blocks("<p>a</p><script>var x = '<p>no</p>'") == ["a"] and blocks("<p>a</p><textarea><p>no") == ["a"]


def test_nothing_below_a_dropped_node_is_kept():
    page = parse("<div class='sidebar'><div><p>" + words(1, 60) + "</p></div></div><div><p>" + words(2, 60) + "</p></div>")
    assert decode(page, hint_margins(features(page))) == words(2, 60)


def test_marked_and_unmarked_pages(spark):
    rows, want = [], {}
    for n in range(60):
        html, text = plain(n)
        if n >= 50:  # the same without any mark of the main part
            html = html.replace("<article>", "<div>").replace("</article>", "</div>")
        rows.append((n, html))
        want[n] = text
    got = {r["page_id"]: r for r in main_texts(pages(spark, rows)).collect()}
    assert all(got[n]["text"] == want[n] and got[n]["n_chars"] == len(want[n]) for n in range(60))


def test_awkward_rows_and_empty_table(spark):
    html, text = plain(1)
    long = HEAD + "<article>" + "".join(f"<p>{words(k, 50)}</p>" for k in range(2000)) + "</article>"
    rows = [(1, html), (1, html), (None, html), (2, None), (3, ""), (4, "   "), (5, long)]
    out = main_texts(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == (text if r["page_id"] in (1, None) else "\n".join(words(k, 50) for k in range(2000)) if r["page_id"] == 5 else "")
    assert main_texts(pages(spark, [])).count() == 0
    bare = main_texts(pages(spark, [(1, "<p>" + words(1, 60) + "</p>"), (2, "no block at all")])).collect()
    assert {r["page_id"]: r["text"] for r in bare} == {1: words(1, 60), 2: "no block at all"}
