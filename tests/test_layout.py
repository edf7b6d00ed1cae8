"""Glyph geometry, pixels, the page reader, sources, recovery, ingestion, command line."""

import base64
import json
import os
import sys
import threading
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from quire import __main__ as cli
from quire import errors
from quire import queries as Q
from quire.functions import layout as L
from quire.functions import pixels as X
from quire.plans import convert as C
from quire.plans import recovery as V
from quire.sources import pdf, reader, serve, sinks, transcripts
from quire.streaming import ingest


def layer(rows, weight=400, turn=0, height=800.0, pitch=12.0):
    """Glyphs 6 wide and 8 high, a line every ``pitch`` points, spaces without boxes."""
    text, boxes = "", []
    for k, row in enumerate(rows):
        for i, c in enumerate(row):
            text += c
            boxes.append(None if c == " " else (i * 6.0, height - 100 - k * pitch, i * 6.0 + 6, height - 92 - k * pitch))
        text += "\n"
        boxes.append(None)
    known = [b is not None for b in boxes]
    return L.Layer(text, boxes, [turn if k else None for k in known], [weight if k else None for k in known], (600.0, height))


def test_folding():
    norm, at = L.folded_map("Ab  ﬁ—x ½ ")
    assert norm == "ab fi x 1 2" and [at[norm.index(c)] for c in "afx"] == [0, 4, 6]
    assert [L.snapped(a) for a in (0, 44, 89, 181, 269, 359)] == [0, 0, 90, 180, 270, 0]


def test_lines_turns_runs():
    assert L.lines_of([(0, 0, 5, 8), None, (6, 2, 9, 10), (0, 20, 4, 28)]) == [(0, 20, 4, 28), (0, 0, 9, 10)]
    assert (L.main_turn([0, 90, 90, 0]), L.main_turn([90, 270]), L.main_turn([])) == (0, 90, 0)
    assert [L.run_around(*x) for x in (([1, 1, 9], 0, 0, 2), ([9], 0, 0, 2), ([1], 1, 1, 2), ([1, 9, 1, 9, 1], 2, 3, 2), ([], 0, 0, 2))] == [(0, 2), (0, 0), (0, 1), (2, 3), (0, 0)]


def test_locating_tables():
    page = layer(["Some title", "", "", "", "alpha beta", "gamma delta", "epsilon", "", "", "", "", "after"])
    box, turn = L.locate(L.anchors_of(["alpha", "beta", "delta", "epsilon", "abc"]), page)
    assert turn == 0 and L.tokens_in(box, page) == ["alpha", "beta", "gamma", "delta", "epsilon"]
    assert L.locate(["nowhere"], page) is None
    twice = layer(["same", "same", "other"])
    assert L.seeds_of(["same"], twice) == ([], []) and len(L.seeds_of(["other"], twice)[0]) == 1
    assert not L.is_captured(box, page, {"alpha", "beta", "gamma", "delta"}) and L.is_captured(box, page, {"alpha", "beta", "gamma", "delta", "epsilon"})
    assert not L.is_captured((500, 0, 510, 5), page, {"x"})
    assert [p.tables for p in L.plans("<table><tr><td>alpha</td><td>delta</td></tr></table>", page)] == [("<table><tr><td>alpha</td><td>delta</td></tr></table>",)]
    assert L.crop_scale((0, 0, 100, 50)) == 600 / 72 and L.crop_scale((0, 0, 5000, 50)) == 200 / 72


def test_crops_replace_regions_that_lose_nothing():
    md = "a\n\n<table><tr><td>x</td></tr></table>\n\nb"
    plan = L.Plan(3, 37, ("<table><tr><td>x</td></tr></table>",), (0, 0, 1, 1), 0)
    better = "<table><tr><td>x</td><td>y</td></tr></table>\nlegend text"
    assert L.with_crops(md, [(plan, better)]) == 'a\n\n<table><tr><td>x</td><td>y</td></tr></table>\n<p class="footnote">legend text</p>\n\nb'
    assert L.with_crops(md, [(plan, "<table><tr><td></td></tr></table>")]) == md == L.with_crops(md, [(plan, "no table")])


def test_rebuilding_two_columns():
    rows = ["Alpha        1 . 5", "Bravo        20", "Charlie      30", "Delta        4000", "Echo"]
    page = layer(rows)
    old = "<table><tr><td>Alpha</td><td>1.5</td></tr><tr><td>Bravo</td><td><em>Charlie</em></td></tr><tr><td>Delta</td><td>4000</td></tr></table>"
    new = L.rebuilt(page, old)
    assert new.count("<tr>") == 5 and "<td>Alpha</td><td>1.5</td>" in new and "<td><em>Charlie</em></td><td>30</td>" in new and '<td colspan="2">Echo</td>' in new
    assert L.repaired(f"x {old} y", page) == f"x {new} y"
    assert L.rebuilt(layer(["Alpha 1"]), old) is None
    three = "<table><tr><td>Alpha</td><td>Bravo</td><td>c</td></tr></table>"
    assert L.repaired(three, page) == three


def test_bold_cells():
    page = layer(["alpha beta", "gamma"], weight=700)
    assert L.bolded("<table><tr><th>alpha</th><td>beta</td></tr><tr><td><b>gamma</b></td></tr></table>", page) == "<table><tr><th>alpha</th><td><strong>beta</strong></td></tr><tr><td><b>gamma</b></td></tr></table>"
    light = layer(["alpha beta"], weight=400)
    assert "<strong>" not in L.bolded("<table><tr><td>alpha</td><td>beta</td></tr></table>", light)


def test_tails():
    raw = "the quick brown fox jumps over the lazy dog and all its friends.\nNext block starts here now ok yes\nfoot 1"
    md = "the quick brown fox jumps over the lazy\n\nNext block starts here now ok yes"
    assert L.reconciled(md, raw, set()).startswith("the quick brown fox jumps over the lazy dog and all its friends.\n\n")
    for bad in (raw + raw, raw.replace("dog and all its friends.", "dog."), raw.replace("dog and all its friends.", "1 2 3 4 5 6 7 8 9 10"), raw.replace("dog and", "© 2019 dog and")):
        assert L.reconciled(md, bad, set()) == md
    assert L.reconciled(md, raw, {"dog and all its friends."}) == md and L.reconciled(md, " ", set()) == md
    assert L.recurring_lines(["Page 1 of\nx", "Page 2 of", "Page 3 of"]) == {"page # of"}
    text, at = L.plain_map(" a ﬁ\n–b ")
    assert text == "a fi -b" and at[2:4] == [3, 3] and at[-1] == 8


def test_missing_figures():
    page = layer(["text above here", "", "", "", "", "", "", "", "", "Figure 2. Growth", "body text below the caption"])
    region, top = L.figure_region(page, 2)
    assert region[3] == 700.0 and region[1] < top < region[3]
    crop = "![image](i.png)100,100,900,900\n\nFigure 2. Growth\n\n(A) one\n\ntail"
    assert L.recovered(crop, 2) == ((100, 100, 900, 900), "Figure 2. Growth\n\n(A) one") and L.recovered(crop, 3)[1] == "" and L.recovered("x", 2) is None
    out = L.with_missing_figures(["page text", "other"], [page, layer(["x"])], lambda p, box: crop, 0)
    assert out[1] == "other" and "![image](image_1.png)" in out[0] and out[0].startswith("![") and "(A) one" in out[0]
    assert L.with_missing_figures(["Figure 2. Growth"], [page], lambda p, b: crop, 0) == ["Figure 2. Growth"]
    assert L.with_missing_figures(["x"], [page], lambda p, b: None, 0) == ["x"]
    assert L.to_page((0, 0, 1000, 1000), (0, 0, 300, 400), (600, 800)) == (0, 500, 500, 1000)


def image(*inked, shape=(1000, 800)):
    out = np.full(shape, 255, np.uint8)
    for x0, y0, x1, y1 in inked:
        out[y0:y1, x0:x1] = 0
    return out


def test_crops():
    figure = (200, 300, 500, 600)
    assert X.cropped(image(figure), (220, 320, 480, 580)).shape == (300, 300)
    assert X.cropped(image(figure), (0, 0, 30, 500)) is None and X.cropped(image(figure), (700, 900, 100, 100)) is None
    assert X.cropped(image(figure), (-50, -50, 900, 1100)).shape == (1000, 800)
    # a caption's thin runs below the box are not part of the figure
    words = [(200 + 20 * i, 605, 210 + 20 * i, 612) for i in range(15)]
    assert X.cropped(image(figure, *words), (200, 300, 500, 600), "Fig. 1. A caption").shape == (300, 300)
    read = lambda part: "Fig 1 growth of cells"
    baked = [(200 + 20 * i, 640, 210 + 20 * i, 648) for i in range(15)]
    assert X.cropped(image(figure, *baked), (200, 300, 500, 650), "Fig. 1. Growth of cells", read).shape[0] < 345

    def fails(part):
        raise OSError

    assert X.cropped(image(figure, *baked), (200, 300, 500, 650), "Fig. 1. Growth", fails).shape[0] >= 300
    assert X.attempted(fails, image()) is None


def test_ink():
    mask = image((0, 10, 10, 20), (0, 40, 10, 60), shape=(100, 10)) < X.INK
    assert X.bands(mask, 5) == [(10, 20), (40, 60)] and X.bands(mask, 30) == [(10, 60)] and X.bands(mask[:62], 5)[-1] == (40, 62)
    assert X.run_end(np.array([0, 1, 1, 0, 0, 0.0]), 2, 3) == 3 and X.run_end(np.array([0, 0, 0, 1.0]), 4, 3) is None and X.run_end(np.ones(4), 2, 1) is None
    assert X.mean_run(np.array([[1, 0, 1, 1], [0, 0, 0, 0]], bool)) == 1.5 / 4
    assert X.clusters([(0, 0, 10, 10), (50, 0, 60, 10), (0, 15, 10, 30), (0, 33, 10, 40)], 5) == [[0, 2, 3], [1]]
    assert X.render_scale(612, 792) == 1540 / 792 and X.render_scale(100, 100) == 200 / 72 and X.fitted(3080, 1000) == (1540, 500)
    assert X.reads_as_caption("growth of cells", {"growth", "of", "cells"}) and not X.reads_as_caption("of of of", {"of"})
    data = X.png(image(shape=(3, 2)))
    at = data.index(b"IDAT") + 4
    assert zlib.decompress(data[at : at + int.from_bytes(data[at - 8 : at - 4], "big")]) == (b"\0" + b"\xff" * 6) * 3


# ---- the page reader
class Service:
    """A service that answers from a list: texts, statuses, or whole payloads."""

    def __init__(self, *answers, context=4096):
        self.answers, self.bodies, self.context = list(answers), [], context

    def __call__(self, url, body, timeout):
        if url.endswith("/models"):
            return json.dumps({"data": [{"max_model_len": self.context}]})
        self.bodies.append(json.loads(body))
        answer = self.answers.pop(0)
        if isinstance(answer, tuple):
            raise reader.HttpFailure(*answer)
        if isinstance(answer, str):
            answer = {"choices": [{"message": {"content": answer}, "finish_reason": "stop"}]}
        return json.dumps(answer)


def made(service, **kw):
    return reader.worker(reader.Reader.connect(transport=service), sleep=lambda s: None, **kw)


def test_reading():
    service = Service("text")
    r = made(service)
    assert r.context == 4096 and r.read(image(shape=(4, 4))) == "text"
    sent = service.bodies[0]
    assert sent["temperature"] == 0.0 and sent["max_tokens"] == 2048
    assert base64.b64decode(sent["messages"][0]["content"][0]["image_url"]["url"].partition(",")[2])[:4] == b"\x89PNG"
    cut = {"choices": [{"message": {"content": "short"}, "finish_reason": "length"}], "usage": {"prompt_tokens": 100}}
    service = Service(cut, "a longer text")
    assert made(service).read(image(shape=(4, 4))) == "a longer text" and service.bodies[1]["max_tokens"] == 4096 - 100 - 64
    assert made(Service(cut, "x")).read(image(shape=(4, 4))) == "short"
    assert made(Service({"choices": [{"message": {"content": None}}]})).read(image(shape=(2, 2))) == ""
    assert made(Service("a", "b")).read_all([image(shape=(2, 2))] * 2) in (["a", "b"], ["b", "a"]) and made(Service()).read_all([]) == []


def test_reader_failures(monkeypatch):
    assert made(Service((503,), (429, {"Retry-After": "99"}), "ok")).read(image(shape=(2, 2))) == "ok"
    for answers in ([(503,)] * 3, [(400,)], [(0,)] * 3):
        with pytest.raises(errors.ReaderUnavailable):
            made(Service(*answers)).read(image(shape=(2, 2)))
    for bad in ({}, {"choices": []}, {"choices": [{"message": {"content": 5}}]}):
        with pytest.raises(errors.ReaderResponse):
            made(Service(bad)).read(image(shape=(2, 2)))
    with pytest.raises(errors.ReaderUnavailable):
        made(Service("a", (400,))).read_all([image(shape=(2, 2))] * 2)

    def down(url, body, timeout):
        raise reader.HttpFailure(0)

    with pytest.raises(errors.ReaderUnavailable):
        reader.Reader.connect(transport=down)
    r = reader.Reader()
    assert r.delay(reader.HttpFailure(429, {"Retry-After": "99"}), 0) == 30.0 and 1.0 <= r.delay(reader.HttpFailure(503), 1) <= 1.5
    assert [reader.context_of(x) for x in ({"data": [{"max_model_len": 5}]}, {"data": []}, None, {"data": [{"max_model_len": -1}]})] == [5, None, None, None]
    monkeypatch.setenv("QUIRE_READER_CONTEXT", "100")
    monkeypatch.setenv("QUIRE_READER_IN_FLIGHT", "0")
    got = reader.Reader.connect("http://h/", transport=Service())
    assert (got.url, got.context, got.in_flight) == ("http://h", 100, 1)
    monkeypatch.setenv("QUIRE_READER_TIMEOUT", "-3")
    with pytest.warns(UserWarning):
        assert reader.setting("TIMEOUT", 600.0) == 600.0
    keep = made(Service())
    keep.transport = down
    with pytest.raises(errors.ReaderUnavailable):
        keep.reconnect()
    assert [e.disposition for e in (errors.ReaderUnavailable, errors.ReaderResponse, errors.BadInput)] == ["retry", "retry_capped", "fail"]


def test_reading_a_relation(spark):
    def connect():
        return reader.Reader(transport=lambda url, body, timeout: json.dumps({"choices": [{"message": {"content": "md"}}]}) if len(body) < 400 else json.dumps({}))

    rows = [("a", 0, 2, 2, bytes(12)), ("a", 1, 40, 40, np.random.default_rng(0).bytes(4800))]
    images = spark.createDataFrame(rows, "doc_id string, page_no int, width int, height int, pixels binary")
    got = {r["page_no"]: r for r in reader.read_pages(images, connect).collect()}
    assert got[0]["md"] == "md" and got[0]["error"] is None
    assert got[1]["md"] is None and got[1]["disposition"] == "retry_capped"


# ---- sources, recovery, ingestion, command line
TEXT = "preamble\n===== PAGE 1 =====\n# A Title\n\nAnn Lee, Bo Ray\n\n## Abstract\n\nWe did.\n===== PAGE 2 =====\n\n## Introduction\n\nBody text.\n"


def test_transcripts(spark, tmp_path):
    (tmp_path / "doc1.raw.md").write_text(TEXT)
    got = sorted(map(tuple, transcripts.read_transcripts(spark, tmp_path.as_uri()).collect()))
    assert got == [("doc1.raw", 0, "# A Title\n\nAnn Lee, Bo Ray\n\n## Abstract\n\nWe did."), ("doc1.raw", 1, "## Introduction\n\nBody text.")]
    for place, stem in (("x", "paper.vx"), ("y", "paper.vy"), ("y", "doc1.raw")):
        (tmp_path / place).mkdir(exist_ok=True)
        (tmp_path / place / f"{stem}.md").write_text(TEXT)
    ids = lambda path: sorted({r["doc_id"] for r in transcripts.read_transcripts(spark, path).collect()})
    assert ids(f"{tmp_path}/*/*.md") == ["x/paper.vx", "y/doc1.raw", "y/paper.vy"]  # equal names in two folders are two documents
    assert ids(f"{tmp_path}/*.md") == ["doc1.raw"] and ids(f"{tmp_path}/x/paper.vx.md") == ["paper.vx"] and ids(str(tmp_path / "y")) == ["doc1.raw", "paper.vy"]


GLYPHS = "doc_id string, page_no int, md string, text string, boxes array<array<double>>, turns array<int>, weights array<int>, page_width double, page_height double, width int, height int, pixels binary"


def glyph_page(doc, n, md, page):
    raster = np.full((800, 600, 3), 255, np.uint8)
    return (doc, n, md, page.text, [b and list(b) for b in page.boxes], list(page.turns), list(page.weights), *page.size, 600, 800, raster.tobytes())


def test_recovery(spark):
    bold = layer(["alpha beta", "gamma delta"], weight=700)
    figure = layer(["text above here that is long enough", *[""] * 8, "Figure 2. Growth of something", "body text below the caption"])
    table = "<table><tr><td>alpha</td><td>beta</td></tr><tr><td>gamma</td><td>delta</td></tr></table>"
    rows = [glyph_page("d", 0, f"x {table}", bold), glyph_page("d", 1, "## Introduction\n\ntext", figure), glyph_page("d", 2, None, layer([]))]
    pages = spark.createDataFrame(rows, GLYPHS)
    got = {r["page_no"]: r["md"] for r in V.repair_tables(pages).collect()}
    assert got[0].count("<strong>") == 4 and got[1] == "## Introduction\n\ntext" and got[2] is None
    crop = "![image](i.png)100,100,900,900\n\nFigure 2. Growth of something"
    got = {r["page_no"]: r["md"] for r in V.recover_figures(pages, lambda: lambda part: crop).collect()}
    assert got[1].startswith("![image](image_1.png)") and got[1].endswith("## Introduction\n\ntext") and len(got) == 3
    read = lambda: lambda part: table.replace("delta</td>", "delta</td><td>more</td>")
    lost = spark.createDataFrame([glyph_page("d", 0, table.replace("delta", "other"), bold)], GLYPHS)
    assert "more" in V.repair_tables(lost, read).first()["md"]
    assert sorted(r["page_no"] for r in V.pages_to_read(pages).collect()) == [1, 2]
    assert {r["ch"] for r in transcripts.glyph_rows(pages).where("turn is not null and page_no = 0").collect()} == set("alphabetgmd")


def test_ingestion(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text(TEXT)
    places = [(tmp_path / p).as_uri() for p in ("in", "out", "state")]
    ingest.ingest(spark, *places).awaitTermination(120)
    (tmp_path / "in" / "two.md").write_text(TEXT.replace("A Title", "Another Title"))
    ingest.ingest(spark, *places).awaitTermination(120)
    got = sorted((r["doc_id"], r["title"]) for r in spark.read.parquet(places[1]).collect())
    assert got == [("one", "A Title"), ("two", "Another Title")]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "one.md").write_text(TEXT)
    assert cli.main([str(tmp_path / "one.md")]) == 0
    assert "<h1>A Title</h1>" in (tmp_path / "one.html").read_text()
    with pytest.raises(SystemExit):
        cli.main([str(tmp_path / "none.md")])
    if "pypdfium2" not in sys.modules:
        (tmp_path / "a.pdf").write_bytes(b"%PDF")
        try:
            pdf.library()
        except errors.BadInput:
            assert cli.main([str(tmp_path / "a.pdf")]) == 1 and "error:" in capsys.readouterr().err


def test_service():
    server = serve.serve(lambda data, most: (f"{len(data) > 50} {most}", 10, most if most == 7 else 3), context=500)
    try:
        with reader.Reader.connect(f"http://127.0.0.1:{server.server_address[1]}/v1") as r:
            assert r.context == 500 and r.read(image(shape=(4, 4))) == "True 2048"
            assert r.post(base64.b64encode(b"x").decode(), 7)[1:] == ("length", 10)
            for bad in ("", "%%%"):
                with pytest.raises(errors.ReaderUnavailable):
                    r.post(bad, 5)
    finally:
        server.shutdown()
    with pytest.raises(errors.ReaderUnavailable):
        reader.Reader.connect(f"http://127.0.0.1:{server.server_address[1]}/v1", transport=lambda *a: reader.http("http://127.0.0.1:9/", None, 1))


def test_connections_are_kept():
    server = serve.serve(lambda data, most: ("md", 10, 3))
    opened = []
    accept = server.get_request

    def get_request():
        link = accept()
        opened.append(link[0])
        return link

    server.get_request = get_request
    try:
        url = f"http://127.0.0.1:{server.server_address[1]}/v1"
        with reader.Reader.connect(url) as r:
            assert r.transport.size == r.in_flight == 4
            assert [r.read(image(shape=(4, 4))) for _ in range(5)] == ["md"] * 5 and len(opened) == 1
            assert r.read_each([image(shape=(4, 4))] * 40) == ["md"] * 40 and len(opened) <= r.in_flight
            before = len(opened)
            for link in opened:
                link.shutdown(2)  # closed by the other side: replaced, not failed
            assert r.read(image(shape=(4, 4))) == "md" and len(opened) == before + 1
            with pytest.raises(reader.HttpFailure) as e:
                r.transport(f"{url}/nothing", None, 5)
            assert e.value.status == 404 and not r.transport.idle.empty()
        assert r.transport.idle.empty()
        for bad in ("ftp://127.0.0.1:9/x", "nonsense", "http://[x", "http://h:port/"):
            with pytest.raises(reader.HttpFailure):
                r.transport(bad, None, 1)
    finally:
        server.shutdown()


class Pdfs:
    """Stands in for a PDF library: a page is white but for its number."""

    def __init__(self):
        self.opened, self.asked = [], []

    def PdfDocument(self, data):  # noqa: N802
        self.opened.append(data)
        library = self

        class Page:
            def render(self, scale, crop):
                library.asked.append((data, scale, crop))
                if data == b"bad":
                    raise RuntimeError("no such page")
                return self

            def to_pil(self):
                from types import SimpleNamespace as Made

                size = (40, 20)
                pixels = np.full((20, 40, 3), len(data), np.uint8)
                made = Made(size=size, resize=lambda to: pixels)
                return Made(convert=lambda mode: made)

        class Document(list):
            def close(self):
                pass

        return Document([Page()])


def test_regions_are_rendered_anew(tmp_path, monkeypatch):
    (tmp_path / "x").mkdir()
    for name, data in (("x/a.pdf", b"one"), ("b.PDF", b"three"), ("bad.pdf", b"bad")):
        (tmp_path / name).write_bytes(data)
    fake = Pdfs()
    monkeypatch.setattr(pdf, "library", lambda: fake)
    region = pdf.Regions(tmp_path.as_uri())
    row = lambda doc: {"doc_id": doc, "page_no": 0, "page_width": 600.0, "page_height": 800.0, "pixels": None}
    box = (100.0, 200.0, 250.0, 300.0)
    assert (region(row("x/a"), box) == 3).all() and (region(row("x/a"), box) == 3).all() and (region(row("b.PDF"), box) == 5).all()
    assert fake.opened == [b"one", b"three"]  # a PDF is opened once
    assert fake.asked[0] == (b"one", 600 / 72, (100.0, 200.0, 350.0, 500.0))  # margins; at the upper bound of the scale
    assert region(row("bad"), box) is None and V.crop(row("bad"), box, region=region) is None
    assert region(row("missing"), box) is None
    assert V.crop(row("x/a"), box, 90, region).shape == (40, 20, 3)
    raster = row("bad") | {"pixels": np.full((800, 600, 3), 7, np.uint8).tobytes(), "width": 600, "height": 800}
    assert V.crop(raster, box, region=region).shape == (100, 150, 3)
    assert (pdf.Regions((tmp_path / "x" / "a.pdf").as_uri())(row("a"), box) == 3).all()


def test_regions_reach_the_recovery(spark):
    figure = layer(["text above here that is long enough", *[""] * 8, "Figure 2. Growth of something", "body text below the caption"])
    pages = spark.createDataFrame([glyph_page("d", 1, "## Introduction\n\ntext", figure)[:11] + (None,)], GLYPHS)  # no raster
    crop = "![image](i.png)100,100,900,900\n\nFigure 2. Growth of something"
    read = lambda: lambda part: crop if part.shape == (30, 60, 3) else ""
    assert "![image]" not in V.recover_figures(pages, read).first()["md"]
    assert "![image]" in V.recover_figures(pages, read, lambda row, box: np.zeros((30, 60, 3), np.uint8)).first()["md"]


def test_sinks(spark, tmp_path):
    put = sinks.folder_sink((tmp_path / "figs").as_uri())
    assert put(b"png", "image/png", 3) == "figs/fig_003.png" and (tmp_path / "figs" / "fig_003.png").read_bytes() == b"png"
    docs = spark.createDataFrame([("a/b", "<p>é</p>"), ("c", ""), ("a_b", "other"), ("a b", "third")], "doc_id string, html string")
    paths = {r["doc_id"]: r["path"] for r in sinks.write_html(docs, (tmp_path / "out").as_uri()).collect()}
    assert len(set(paths.values())) == 4 and Path(paths["a/b"]).read_text("utf-8") == "<p>é</p>"
    assert (tmp_path / "out" / "a_b.html").read_text() == "other" and (tmp_path / "out" / "c.html").read_text() == ""
    one, two = put.for_document("d/1"), put.for_document("d_1")
    assert one(b"1", "image/png", 1) != two(b"2", "image/png", 1) == "figs/d_1/fig_001.png"
    assert (tmp_path / "figs" / "d_1" / "fig_001.png").read_bytes() == b"2"


def test_pages_of_pdfs_are_read_once(spark, tmp_path):
    """From rasters and glyphs to documents: one request a page, tables, figures and crops of two documents."""
    intro = layer(["## Introduction", "plain text of the page that goes on"])
    figure = layer(["text above here that is long enough", *[""] * 8, "Figure 2. Growth of something", "body text below the caption"])
    bold = layer(["alpha beta", "gamma delta"], weight=700)
    table = "<table><tr><td>alpha</td><td>beta</td></tr><tr><td>gamma</td><td>delta</td></tr></table>"
    mds = ["# T\n\n## Introduction\n\ntext", "body text", f"x\n\n{table}"]
    crop = "![image](i.png)100,100,900,900\n\nFigure 2. Growth of something"
    seen = tmp_path / "seen"
    seen.mkdir()

    class Fake:
        def read(self, part):
            (seen / f"crop-{os.getpid()}-{id(part)}-{len(list(seen.iterdir()))}").touch()
            return crop

        def read_each(self, images):
            out = []
            for part in images:
                doc, n = int(part[0, 0, 0]), int(part[0, 0, 1])
                (seen / f"page-{doc}-{n}-{len(list(seen.iterdir()))}").touch()
                out.append(errors.ReaderResponse("no content") if doc == 3 and n == 1 else mds[n])
            return out

    rows = []
    for doc in (1, 2, 3):
        for n, page in enumerate((intro, figure, bold)):
            raster = np.full((800, 600, 3), 255, np.uint8)
            raster[200:500, 100:500] = 0
            raster[0, 0, :2] = doc, n
            rows.append((f"x/{doc}", n, 600, 800, raster.tobytes(), page.text, [b and list(b) for b in page.boxes], list(page.turns), list(page.weights), *map(float, page.size)))
    source = spark.createDataFrame(rows, pdf.SCHEMA).repartition(3)
    documents, failures = C.convert(source, Fake, sink=sinks.folder_sink((tmp_path / "figs").as_uri()))
    got = {r["doc_id"]: r["html"] for r in documents.collect()}
    assert [(r["doc_id"], r["page_no"], r["disposition"]) for r in failures.collect()] == [("x/3", 1, "retry_capped")]
    assert sorted(got) == ["x/1", "x/2"]
    for doc, page in got.items():
        assert page.count("<strong>alpha") == 1 and "Growth of something" in page[page.index("<figure>") : page.index("</figure>")], page[-900:]
        assert f'src="figs/{sinks.file_name(doc)}/fig_001.png"' in page
    assert len(list((tmp_path / "figs").glob("*/fig_001.png"))) == 2
    pages = Counter(tuple(x.name.split("-")[1:3]) for x in seen.glob("page-*"))
    assert len(pages) == 9 and set(pages.values()) == {1}


def test_reading_in_flight():
    gate = threading.Barrier(3)

    def transport(url, body, timeout):
        gate.wait(5)  # passes only if three requests are in flight
        return json.dumps({"choices": [{"message": {"content": "md"}}]})

    r = reader.Reader(transport=transport)
    r.in_flight = 3
    assert r.read_each([image(shape=(4, 4))] * 6) == ["md"] * 6


def test_every_box_is_cropped(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey <= 60").coalesce(1).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    rows = spark.read.parquet(f"file://{tmp_path}/lineitem.parquet").collect()
    want, place = [], Counter()
    for r in sorted(rows, key=lambda r: (r["l_orderkey"], r["l_linenumber"], r["l_partkey"], r["l_suppkey"], r["l_quantity"])):
        place[r["l_orderkey"]] += 1
        k = place[r["l_orderkey"]]
        x, y = r["l_partkey"] % 700, r["l_suppkey"] * 37 % 600
        right, bottom = int(x + r["l_quantity"] * 4), y + 40 + r["l_linenumber"] * 20
        page = np.array([[0 if y <= i < bottom and x <= j < right else 255 for j in range(800)] for i in range(800)], np.uint8)
        got = X.cropped(page, (x + 5, y + 5, right - 5, bottom - 5), "Fig. 1. Drawn" if k % 2 else None)
        want.append((r["l_orderkey"], k, *((0, 0) if got is None else got.shape[::-1])))
    assert len(want) == len(rows) > len(place) and any(k % 2 == 0 and w for _, k, w, _ in want)
    assert sorted(map(tuple, Q.figure_crops(spark, f"file://{tmp_path}").select("page", "k", "width", "height").collect())) == sorted(want)
