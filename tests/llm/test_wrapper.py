import random

from hirescope.llm import wrapper as W


def plain_stm(a, b):
    """Simple tree matching by the definition, runs of equal siblings as one."""
    def runs(kids):
        return [k for i, k in enumerate(kids) if not i or kids[i - 1].label != k.label]

    def children(x, y):
        best = {}

        def at(i, j):
            if not i or not j:
                return 0
            if (i, j) not in best:
                w = match(x[i - 1], y[j - 1]) if x[i - 1].label == y[j - 1].label else 0
                best[i, j] = max(at(i - 1, j), at(i, j - 1), at(i - 1, j - 1) + w)
            return best[i, j]
        return at(len(x), len(y))

    def match(p, q):
        return 1 + children(runs(p.kids), q.kids)
    return children(runs(a.kids), b.kids)


def tree(rng, depth=3):
    node = W.Node(rng.choice("abc"))
    if depth:
        node.kids = [tree(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return node


def no_runs(node):
    node.kids = [k for i, k in enumerate(node.kids) if not i or node.kids[i - 1].label != k.label]
    for k in node.kids:
        no_runs(k)
    return node


def test_simple_tree_matching():
    rng = random.Random(1)
    for _ in range(200):
        a, b = tree(rng), no_runs(tree(rng))
        best, pairs = W.match_children(a.kids, b.kids)
        assert best == plain_stm(a, b)
        assert [k for run, _ in pairs for k in run] == a.kids
        used = [id(s) for _, s in pairs if s]
        assert used == [id(s) for s in b.kids if id(s) in set(used)]


def texts(html):
    return [t for _, _, _, t in W.parse(html)[1]]


def test_parser():
    assert texts("<p>a &amp; b<p>c\n  d<br>e<!-- x --><b>f</b>g</p>h") == ["a & b", "c d efg", "h"]
    assert texts('<script>"</p>"; a<b</script><style>p{}</style><p title="a>b">x</p><title>t</title>') == ["x"]
    assert texts('<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>') == ["a", "b", "1", "2", "3"]
    assert texts("<div class='side-bar'>k</div><div class=sidebar>n</div><div id='user-comments'>n</div>"
                 "<form>n</form><nav><p>n</nav><p>y<p hidden>n</p><p style='display: none'>n</p>") == ["k", "y"]
    assert texts("x &lt;p&gt; &nbsp;&eacute;&#233; <p unclosed=\"q>tail") == ["x <p> éé", "tail"]
    assert texts("") == [] and texts("<" * 50) == ["<" * 50]
    deep = "<div>" * 3000 + "end"
    assert texts(deep) == ["end"]


def page(title, paras, promo="Read our newsletter every week", tag="article"):
    body = "".join(f"<p>{p}</p>" for p in paras)
    return (f"<html><head><title>{title}</title></head><body><header><h1>Site</h1></header><nav><a href=/x>menu {title}</a>"
            f"</nav><{tag}><h1>{title}</h1>{body}<p>{promo}</p><section class='comments'><p>nice {title}</p></section>"
            f"</{tag}><aside>more {title}</aside><footer>&copy; {title}</footer></body></html>")


def test_extraction(spark):
    rows, want = [], {}
    for host in ("a.example", "b.example"):
        for i in range(9):
            key = len(rows)
            paras = [f"Story {host} {i} paragraph {j}" for j in range(i % 4 + 1)]
            rows.append((key, f"https://{host}/{i}", page(f"T {host} {i}", paras, tag="article" if host[0] == "a" else "div")))
            want[key] = "\n".join([f"T {host} {i}", *paras])
    single = page("Lonely", ["only page"], "same words here")
    rows += [(50, "https://c.example/1", single), (51, "https://c.example/1", single), (52, "https://c.example/2", single),
             (53, "https://c.example/3", single), (60, None, None), (61, "x", ""), (None, None, "<p>t</p>"),
             (62, "https://d.example/", "<p>" + "long " * 50_000 + "</p>")]
    want |= {50: "Lonely\nonly page\nsame words here"}
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, row int")
    got = W.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert all(by[k] == v for k, v in want.items())
    assert by[51] == by[52] == by[53] == by[50]        # copies don't make their own text a template
    assert by[60] == by[61] == "" and by[None] == "t" and by[62] == ("long " * 50_000).strip()
    assert W.extract(df.limit(0)).count() == 0
