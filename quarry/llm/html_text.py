"""HTML extraction by layout-aware rendering.

A page is tokenised, and a tree builder keeps the path of open elements: void
elements never open, implied end tags close paragraphs, list items, cells and
rows, stray end tags are ignored, unclosed elements end with their parents.
Elements that a browser does not show (head, script, style, template, hidden
attributes, inline ``display:none`` or ``visibility:hidden``) emit nothing with
all they hold. Of ``svg`` the text elements and foreign objects are shown (what
``use`` refers to is not followed), of ``math`` all but annotations and phantoms,
of ``select`` the chosen option or, as a list box, all options. All other text is emitted: inline text with white space folded,
blocks on their own lines with blank lines where a browser leaves a margin, list
items indented with bullets or numbers, ``pre`` as it stands, and table cells
aligned in columns. Text in a table but in no cell stands before the table, as in
browsers. Only the open path is held.

Work and output stay in proportion to the page, whatever its markup: the open
path is searched by name, columns are at most ``COLUMN_WIDTH`` wide (a longer line
of a cell pushes the rest of its row), a row whose alignment would take more than
``PADDING`` times its text is written cell by cell, lists and quotes are indented
up to ``INDENTS`` levels, and tables nested deeper than ``TABLE_DEPTH`` are written
cell by cell.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import slices, to_workers

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video canvas".split())
#: Elements of embedded vocabularies that show nothing, those whose text stands apart, those that hold HTML, HTML that ends them.
NOT_DRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter annotation annotation-xml mphantom".split())
APART = frozenset("text foreignobject mtd".split())
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
                     "pre ruby s small span strong strike sub sup table tt u ul var".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure fieldset hr".split())
BLOCK = MARGIN | frozenset("html body div section article main header footer nav aside address li dt dd form details summary figcaption "
                           "center legend caption tr td th thead tbody tfoot optgroup option menu dir".split())
CLOSES_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption option optgroup".split())
#: An opening element ends an open one of these, unless one of the second set stands between.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
           "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
           "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option"}, {"select"}),
           "body": ({"head"}, {"body"})}
#: A part of a table ends all that is open above one of these (or a template), as a tree builder goes back to the table.
PLACE = {"td": {"tr", "tbody", "thead", "tfoot", "table"}, "tr": {"tbody", "thead", "tfoot", "table"}, "tbody": {"table"}}
PLACE.update(th=PLACE["td"], thead=PLACE["tbody"], tfoot=PLACE["tbody"], caption=PLACE["tbody"])
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
HEAD_ONLY = frozenset("head title meta link base style script noscript template html".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: What becomes of text in an element: shown, hidden, shown in text elements only (svg), kept for the open option (select).
SHOW, HIDE, DRAW, CHOOSE = range(4)
COLUMN_WIDTH, PADDING, INDENTS, TABLE_DEPTH = 40, 50, 20, 16


class _Flow:
    """Lines of one block context (the page or a table cell)."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []      # pieces of the open line, none of them empty
        self.gap = 0                   # blank lines owed before the next text
        self.prefix: list[str] = []    # indentation of open lists and quotes
        self.marker = ""               # bullet of the item that has no text yet

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.split("\n")
            self.put(first)
            for x in rest:
                self.end(keep=True)
                self.put(x)
            return
        s = SPACES.sub(" ", s)
        if s.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            s = s[1:]
        self.put(s)

    def put(self, s: str) -> None:
        if not s:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            lead = "".join(self.prefix[-INDENTS:])
            if self.marker:
                lead = lead[:len(lead) - len(self.marker)] + self.marker
                self.marker = ""
            self.line = [lead + s]
        else:
            self.line.append(s)

    def end(self, keep: bool = False) -> None:
        """Ends the current line; ``keep`` also ends an empty one."""
        if self.line or keep:
            line = "".join(self.line)
            self.lines.append(line.rstrip(" ") if not keep else line)
            self.line = []

    def margin(self) -> None:
        self.end()
        self.gap = 1

    def done(self) -> list[str]:
        self.end()
        return self.lines


class _Table:
    def __init__(self, holder: _Flow, plain: bool):
        self.holder, self.plain, self.rows = holder, plain, []

    def render(self) -> list[str]:
        """Lines in which the cells of a column start at the same place; columns are two spaces apart."""
        width: dict[int, int] = {}
        for row in self.rows:
            for j, cell in enumerate(row):
                width[j] = max(width.get(j, 0), max((len(x) for x in cell if len(x) <= COLUMN_WIDTH), default=0))
        out = []
        for row in self.rows:
            tall = max(map(len, row), default=0)
            if tall > 1 and tall * sum(width[j] + 2 for j in range(len(row))) > PADDING * sum(len(x) + 1 for cell in row for x in cell):
                out += [x for cell in row for x in cell]
                continue
            for k in range(tall):
                out.append("  ".join((cell[k] if k < len(cell) else "").ljust(width[j]) for j, cell in enumerate(row)).rstrip())
        return out


class _Choice:
    """Options of an open ``select``."""

    def __init__(self, a: dict):
        self.listed = "multiple" in a or bool(re.fullmatch(r"0*([2-9]|[1-9]\d+)", a.get("size", "").strip()))
        self.lines: list[dict] = []                 # options and labels of groups, in order
        self.open: dict | None = None
        self.dead = False                           # the open group is disabled

    def start(self, tag: str, a: dict, unseen: bool) -> None:
        line = {"label": html.unescape(a.get("label", "")), "text": [], "unseen": unseen, "option": tag == "option",
                "selected": "selected" in a, "dead": self.dead or "disabled" in a}
        if tag == "optgroup":
            self.dead = "disabled" in a
        else:
            self.open = line
        self.lines.append(line)

    def end(self, tag: str) -> None:
        self.open = None
        if tag == "optgroup":
            self.dead = False

    def shown(self) -> list[str]:
        if self.listed:
            lines = [x for x in self.lines if not x["unseen"]]
        else:
            options = [x for x in self.lines if x["option"]]
            lines = [x for x in options if x["selected"]][-1:] or [x for x in options if not x["dead"]][:1]
        return [t for x in lines if (t := SPACES.sub(" ", x["label"] or "".join(x["text"])).strip(" "))]


class Renderer:
    def __init__(self):
        self.open: list[tuple[str, int]] = []       # (element, what becomes of its text)
        self.places: dict[str, list[int]] = {}      # element -> its places in the open path
        self.foreign = 0                            # open svg and math elements
        self.choice: _Choice | None = None
        self.flow = _Flow()
        self.tables: list[_Table] = []
        self.lists: list[list] = []                 # [kind, next number]
        self.pre = 0

    def hidden(self) -> bool:
        return self.state() != SHOW

    def state(self) -> int:
        return self.open[-1][1] if self.open else SHOW

    def start(self, tag: str, attributes: str) -> None:
        if self.foreign and tag in BREAKOUT:
            self.break_out()
        if self.choice and tag in ("select", "input", "textarea"):
            self.end("select")
            if tag == "select":
                return
        if self.open and self.open[-1][0] == "head" and tag not in HEAD_ONLY:
            self.end("head")
        if tag in IMPLIED:
            closes, barrier = IMPLIED[tag]
            self.close_to(closes, barrier)
        if tag in PLACE and self.tables:
            self.back_to(PLACE[tag] | {"template"})
        if tag in CLOSES_P:
            self.close_to({"p"}, {"button", "td", "th", "table", "body"})
        a = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        above = self.state()
        unseen = (tag in HIDDEN or "hidden" in a or bool(UNSEEN.search(a.get("style", "")))
                  or tag == "input" and a.get("type", "").lower() == "hidden")
        if self.foreign:
            unseen = unseen or tag in NOT_DRAWN or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse")
        state = HIDE if unseen else above
        if above == HIDE:
            state = HIDE
        elif tag in ("option", "optgroup") and above == CHOOSE:
            self.choice.start(tag, a, unseen)
            state = CHOOSE
        elif not unseen and tag == "svg" and above == SHOW:
            state = DRAW
        elif not unseen and tag in ("text", "foreignobject") and above == DRAW:
            state = SHOW
        if tag in VOID:
            if state == SHOW:
                if tag == "br":
                    self.flow.end(keep=True)
                elif tag == "hr":
                    self.flow.margin()
            return
        foreign = self.foreign or tag in ("svg", "math")
        if attributes.endswith("/") and foreign and not (a and a[next(reversed(a))].endswith("/")):
            return                                  # <x/> in embedded vocabularies, with or without attributes
        if attributes.endswith("/") and tag not in BLOCK and tag not in RAW and a and not a.get(next(reversed(a)), "").endswith("/"):
            return                                  # <x/> of embedded vocabularies
        if tag == "select" and state == SHOW:
            self.choice, state = _Choice(a), CHOOSE
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, state))
        self.foreign += tag in ("svg", "math")
        if state == SHOW:
            self.enter(tag, a)

    def last(self, tags) -> int:
        """Place of the innermost open element of ``tags``, -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def end(self, tag: str) -> None:
        barrier = self.last(("table",)) if tag not in ("table", "body", "html") else -1
        place = self.last((tag,))
        if place > barrier:
            self.close(place)
        elif barrier < 0 and tag == "p" and not self.hidden():     # a stray </p> is an empty paragraph
            self.flow.margin()

    def close_to(self, closes: set, barrier: set) -> None:
        place = self.last(closes)
        if place > self.last(barrier - closes):
            self.close(place)

    def break_out(self) -> None:
        """Ends embedded vocabularies, up to an element of theirs that holds HTML."""
        while self.foreign:
            place = self.last(("svg", "math"))
            if self.last(HOLDS_HTML) > place:
                return
            self.close(place)

    def apart(self) -> None:
        """A space between neighbouring texts of one line."""
        if self.flow.line and not self.flow.line[-1].endswith(" "):
            self.flow.put(" ")

    def back_to(self, places: set) -> None:
        """Ends what is open above the innermost of ``places``."""
        place = self.last(places)
        if place >= 0:
            self.close(place + 1)

    def pop(self) -> None:
        tag, state = self.open.pop()
        self.places[tag].pop()
        self.foreign -= tag in ("svg", "math")
        if state == SHOW:
            self.leave(tag)
        elif state == CHOOSE and tag in ("option", "optgroup"):
            self.choice.end(tag)
        elif state == CHOOSE and tag == "select":
            self.choose()

    def choose(self) -> None:
        """Writes the shown options of the ``select`` that ends: one in the line, those of a list box in lines of their own."""
        choice, self.choice = self.choice, None
        if choice.listed:
            self.flow.end()
        for x in choice.shown():
            self.apart()
            self.flow.put(x)
            if choice.listed:
                self.flow.end()
        self.apart()

    def enter(self, tag: str, a: dict) -> None:
        f = self.flow
        if tag == "table":
            f.margin()
            self.tables.append(_Table(f, len(self.tables) >= TABLE_DEPTH))
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1].plain:
            f.end()
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            self.flow = _Flow()
        elif tag in ("ul", "ol", "menu", "dir"):
            f.end()
            if not self.lists:
                f.gap = 1
            start = a.get("start", "")
            self.lists.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
        elif tag == "li":
            f.end()
            kind = self.lists[-1] if self.lists else ["ul", 1]
            f.marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
            kind[1] += 1
            f.prefix.append(" " * len(f.marker))
        elif tag == "blockquote":
            f.margin()
            f.prefix.append("  ")
        elif tag == "dd":
            f.end()
            f.prefix.append("  ")
        elif tag == "pre":
            f.margin()
            self.pre += 1
        elif tag == "q":
            f.put('"')
        elif tag in APART and self.foreign:
            self.apart()
        elif tag in MARGIN:
            f.margin()
        elif tag in BLOCK:
            f.end()

    def leave(self, tag: str) -> None:
        f = self.flow
        if tag == "table" and self.tables:
            t = self.tables.pop()
            self.flow = t.holder
            self.flow.end()
            for x in t.render():
                self.flow.put(x)
                self.flow.end(keep=True)
            self.flow.margin()
        elif tag in ("td", "th") and self.tables and self.tables[-1].plain:
            f.end()
        elif tag in ("td", "th") and self.tables:
            self.tables[-1].rows[-1].append(f.done())
            self.flow = self.tables[-1].holder          # text between cells comes out before the table
        elif tag == "tr" or tag in ("thead", "tbody", "tfoot"):
            pass
        elif tag in ("ul", "ol", "menu", "dir"):
            f.end()
            if self.lists:
                self.lists.pop()
            if not self.lists:
                f.gap = 1
        elif tag == "li" or tag == "dd":
            f.end()
            f.marker = ""
            if f.prefix:
                f.prefix.pop()
        elif tag == "blockquote":
            f.margin()
            if f.prefix:
                f.prefix.pop()
        elif tag == "pre":
            self.pre -= 1
            f.margin()
        elif tag == "q":
            f.put('"')
        elif tag in APART and self.foreign:
            self.apart()
        elif tag in MARGIN:
            f.margin()
        elif tag in BLOCK:
            f.end()

    def text(self, s: str) -> None:
        if s and self.state() == CHOOSE:
            if self.choice.open:
                self.choice.open["text"].append(html.unescape(s).replace("\xa0", " "))
        elif s and not self.hidden():
            if self.pre and s.isspace() and self.open[-1][0] in TABLE_PARTS:
                return                                  # white space between cells has no place, not even in pre
            s = html.unescape(s) if "&" in s else s
            self.flow.text(s.replace("\xa0", " ") if not self.pre else s, self.pre > 0)


def render(page) -> str:
    """Visible text of a page as laid out; null and empty pages give the empty text."""
    if not isinstance(page, str) or not page:
        return ""
    r = Renderer()
    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            r.text(page[at:])
            break
        r.text(page[at:m.start()])
        at = m.end()
        if m[1]:
            r.end(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            r.start(tag, m[3] or "")
            if tag in RAW and r.open and r.open[-1][0] == tag:      # no markup up to the end tag
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                r.text(page[at:close.start()] if close else page[at:])
                at = close.end() if close else len(page)
                r.end(tag)
    while r.open:
        r.pop()
    lines = r.flow.done()
    while lines and not lines[-1].strip():
        lines.pop()
    while lines and not lines[0].strip():
        lines.pop(0)
    return "\n".join(lines)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(<id_col>, text, n_lines, n_words)`` for every row: the visible text of each whole page.

    Defined cases: null and empty pages give the empty text, 0 lines and words;
    broken markup never fails (what is no tag is text); repeated rows get equal
    results; other columns are never read; an empty table gives an empty result.
    """
    to_workers(pages.sparkSession)

    def run(batches):
        for big in batches:
            for pdf in slices(big, "page"):
                texts = [render(x) for x in pdf["page"]]
                yield pd.DataFrame({"id": pdf["id"], "text": texts, "n_lines": [t.count("\n") + 1 if t else 0 for t in texts],
                                    "n_words": [len(t.split()) for t in texts]})

    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("page"))
    return base.mapInPandas(run, "id long, text string, n_lines long, n_words long").withColumnRenamed("id", id_col)
