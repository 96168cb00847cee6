"""What names and neighbours may take from pages, and a reader of known pages."""

import random
import time

from adlens.llm import html_text


def test_names_that_say_something_else_take_nothing():
    keep = [
        '<section id="discussion"><h2>Discussion</h2><p>We find this.</p></section>', '<section id="related-work"><p>Others found that.</p></section>', '<h2 id="notice">Notice period</h2>', '<h2 id="login" class="nav">Login to it</h2>',
        '<div class="share-price"><p>Shares rose.</p></div>', '<div class="search-results">Found by search.</div>', '<p id="comments">Comments of the chair.</p>', '<li id="feedback">Feedback loops</li>', '<section id="newsletter">A newsletter of 1890.</section>',
    ]
    gone = [
        '<div class="ad">Buy</div>', '<div class="ad-slot-728x90">Buy more</div>', '<section class="newsletter">Sign up</section>', '<div id="comments"><p>First!</p></div>', '<section class="comments-area"><p>Nice</p></section>', '<ol class="commentlist"><li>So so</li></ol>',
        '<div class="notice">Closed today</div>', '<div id="cookie-notice-box">Cookies</div>', '<aside>See also</aside>', '<form><input><p>Your mail</p></form>', '<div class="related-articles">More</div>', '<p class="advert">Buy it</p>', '<div class="social-share-buttons">Tweet</div>', '<nav>Up</nav>', '<footer>End</footer>',
    ]
    text = lambda x: html_text.lines(f"<div>{x}</div>")[0]
    for piece in keep:
        page = f"<body><article><h1>Head</h1><p>A first paragraph of it.</p>{piece}<p>A last one.</p></article></body>"
        inner = [y for y in text(piece.replace("id=", "data-x=").replace("class=", "data-y=")) if y]
        assert html_text.lines(page)[0] == ["Head", "A first paragraph of it.", *inner, "A last one."], piece
    for piece in gone:
        page = f"<body><article><h1>Head</h1><p>A first paragraph of it.</p>{piece}<p>A last one.</p></article></body>"
        assert html_text.lines(page)[0] == ["Head", "A first paragraph of it.", "A last one."], piece


def test_what_stands_in_main_beside_its_article():
    page = "<main><h1>Headline</h1><article><p>The long text of this article, told at length.</p></article><div class='x1'>Teaser</div></main>"
    assert html_text.lines(page)[0] == ["Headline", "The long text of this article, told at length."]
    page = "<main><p>The long text of this page, which is told at length here.</p><article>Card</article></main>"
    assert html_text.lines(page)[0] == ["The long text of this page, which is told at length here.", "Card"]


def test_headings_and_moving_lines_of_thirty_articles(spark):
    rng = random.Random(9)
    say = lambda n=12: " ".join(rng.choice("klmnopqrst") + str(rng.randrange(10**6)) for _ in range(n))
    rows, want = [], {}
    for i in range(30):
        own = [say() for _ in range(rng.randint(2, 7))]
        tail = ["Read our guide to all of it", say(4)]
        body = [*own, *(tail if i % 2 else reversed(tail))]
        rows.append((i, f"https://r.org/w/{i:02}", "<article><h1>Weekly report</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</article>"))
        want[i] = "\n".join(["Weekly report", *[x for x in body if x != tail[0]]])
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def page_of(rng):
    """A page and the lines that are its main text."""
    n, lines = iter(range(10**6)), []

    def say():
        return f"word{next(n)} and some more & that"

    def block(depth, kept):
        tag, attrs, out = rng.choice([("p", "", False), ("div", "class='x body-text'", False), ("section", "id='share'", False), ("h2", "id='menu'", False), ("blockquote", "", False), ("div", "class='ad'", True), ("nav", "", True), ("aside", "", True), ("div", "id='comments'", True), ("div", "hidden", True), ("ul", "class='pagination'", True)])
        kept = kept and not out
        inner = ""
        for _ in range(rng.randint(1, 3)):
            if depth and tag in ("div", "section", "blockquote", "aside", "nav") and rng.random() < 0.5:
                inner += block(depth - 1, kept)
            else:
                a, b = say(), say()
                child = rng.choice(["{}<b> {}</b>", "<span>{}</span> <a href='/x?a=1&b=2'>{}</a>", "{}<!-- no --><script>var x='<p>';</script> {}"])
                one = child.format(a.replace("&", "&amp;"), b.replace("&", "&#38;"))
                inner += f"<div>{one}</div>"
                if kept:
                    lines.append(f"{a} {b}")
        if tag in ("p", "h2"):  # hold no blocks
            inner = inner.replace("<div>", "<i>").replace("</div>", "</i> ")
            if kept:
                own = [lines.pop() for _ in range(inner.count("<i>"))][::-1]
                lines.append(" ".join(own))
        return f"<{tag} {attrs}>{inner}</{tag}>"

    body = "".join(block(2, True) for _ in range(rng.randint(3, 8)))
    while not lines:
        body += block(0, True)
    head = f"<!doctype html><html><head><title>{say()}</title><style>p{{}}</style></head><body><nav>{say()}</nav><header>{say()}</header>"
    return f"{head}<article>{body}</article><footer>{say()}</footer><div>{say()}</div></body></html>", lines


def test_known_pages_are_read_whole():
    rng = random.Random(4)
    for _ in range(400):
        page, want = page_of(rng)
        assert html_text.lines(page)[0] == want, page


def test_lines_that_differ_are_compared_in_little_time():
    rng = random.Random(1)
    a, b = ([rng.getrandbits(63) for _ in range(16_000)] for _ in range(2))
    near = [x ^ 0xFF ^ 0xFF0000 for x in a[:50]]
    began = time.time()
    assert html_text.edited(a, b + near) >= 50
    assert time.time() - began < 2
