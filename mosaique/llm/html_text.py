"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page becomes a flat list of blocks (text between block-level tags). Each has its word count and link density, those of the
blocks before and behind, and how the page's words lie around it: whether it is outside the innermost container that holds half of
the unlinked words, and the share of them that this container has. Flags say what it stands in: a heading, a list item or
table cell, behind a heading, an article, a container that its tag or its class and id hint to be none (menus, footers, sidebars,
adverts, forms, notices, reader comments). A CART tree on these features, trained on the small labelled table PAGES below, keeps
or drops the block; kept blocks are joined in page order by line breaks. In that table names mislead as often as on real pages
(articles in containers called after a search or a side, comments in ones without a telling name, lists of links in articles), so
that the tree asks for words and densities first and for names where those don't decide.

Null, empty or text-free html: the empty text. Scripts, styles, comments, markup, titles and form controls are no text.
Markup that is cut off or badly nested is read as far as it goes; open tags end with their container. Character references
are decoded as HTML5 does, also without a semicolon. Repeated pages each get their row. Very long pages are read whole, in
time linear in their length. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mosaique.llm.common import slices

#: Tags whose content is no text, tags that end a block, tags that hold blocks, tags of boilerplate.
SILENT = "script style noscript template svg math iframe object head select textarea button option canvas audio video map".split()
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HOLDERS = set("article aside blockquote body center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
BOILER = set("nav footer aside form menu dialog fieldset".split())
HINTS = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert\w*|banner\w*|sponsor\w*|promo\w*|comments?|commentlist|replies|reply|respond|responses?|discussion|feedback|disqus|user[-_]?(?:posts?|comments?)"
    r"|cookies?\w*|consent|notices?|alert|popup|modal|newsletter|subscribe|sidebar\w*|side|menu\w*|nav\w*|breadcrumbs?|footer\w*|foot|masthead|toolbar|share|sharing|social|related"
    r"|recommended|pagination|pager|widget\w*|login|search|skip)(?:$|[-_\s])",
    re.I,
)
#: What names a container of the text itself, whatever else its name says.
TEXTS = re.compile(r"(?:^|[-_\s])(?:content|article|story|entry|post|main|text|body|prose)(?:$|[-_\s])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
LABELS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
FEATURES = [
    "words", "density", "words_before", "density_before", "words_behind", "density_behind", "outside", "contained",
    "heading", "item", "headed", "article", "hint",
]
#: The features in front that are words, densities and shares of words; the tree's depth and smallest leaf; the share of words
#: that makes a container the main one whatever its name.
MEASURED, DEPTH, LEAST, HINTED = 8, 16, 2, 0.9

#: The labelled table: pages with counts for texts. +40/3 is a block of main text with 40 words, 3 of them in links; - is not main.
BLOCK = re.compile(r"([+-])(\d+)(?:/(\d+))?")
PAGES = [
    # Markup as templates and page builders make it: containers whose names tell nothing, in many orders.
    "<ul><li>-1/1<li>-1/1<li>-1/1<li>-1/1</ul><div class=c3>-9</div><div class=c4><h1>+7</h1><p>+34<p>+12<p>+58/2<p>+6</div><div class=c9>-11</div>",
    "<div class=row><div class=col>-2/2</div><div class=col>-1/1</div></div><div class=row><h1>+5</h1><p>+49<p>+3<p>+71</div><div class=row>-8/3</div>",
    "<div id=w><div id=a><p>-3/3<p>-6</div><div id=b><h2>+4</h2><p>+66<p>+1<p>+23<p>+90/5</div><div id=c><p>-2/2<p>-14</div></div>",
    "<ul><li>-2/2<li>-1/1<li>-2/2</ul><div>-5</div><section><h1>+9</h1><p>+18<p>+27<p>+2<p>+41</section><section>-7/7</section><div>-12/2</div>",
    "<div class=x><ul><li>-1/1<li>-1/1<li>-1/1</ul></div><div class=y>-13</div><div class=z><p>+52<p>+8<p>+33<ul><li>+4<li>+7<li>+6</ul><p>+29</div><div class=q>-10</div>",
    "<table><tr><td>-1/1<td>-1/1<td>-2/2</table><table><tr><td><p>+77<p>+5<p>+64</table><table><tr><td>-9<td>-3/3</table>",
    "<div class=s1>-4</div><div class=s2><h1>+10</h1><p>+10<p>+2<p>+37<p>+1<p>+80</div><div class=s3>-15</div>",
    "<div class=s1>-12</div><div class=s2><h1>+3</h1><p>+3<p>+21</div><div class=s3>-10</div>",
    "<ul><li>-1/1<li>-1/1</ul><div>-7</div><div><h1>+2</h1><p>+2<p>+33<p>+17<p>+12<p>+6</div><div>-12</div>",
    "<ul><li>-1/1<li>-1/1<li>-1/1<li>-1/1<li>-1/1<li>-1/1</ul><div>-10</div><div><h1>+8</h1><p>+9<p>+45<p>+9<p>+5</div><div>-14</div>",
    "<ul><li>-1/1<li>-1/1<li>-1/1</ul><div>-6</div><div><h1>+8</h1><p>+8<p>+27<p>+31<p>+9</div><div>-13</div>",
    "<ul><li>-1/1<li>-1/1<li>-1/1<li>-1/1</ul><div>-4</div><div><h1>+11</h1><p>+23<p>+58</div><div>-15</div>",
    "<ul><li>-1/1<li>-1/1</ul><div>-9</div><div><h1>+1</h1><p>+1<p>+4<p>+7</div><div>-8</div>",
    "<div class=g><div class=k>-1/1</div><div class=k>-1/1</div></div><div class=g><div class=k>+44</div><div class=k>+12</div><div class=k>+73/4</div></div><div class=g><div class=k>-5/5</div><div class=k>-11</div></div>",
    "<div id=p1><p>-2/2<p>-3/3</div><div id=p2><p>+120<p>+1<p>+2<p>+95</div><div id=p3><p>-7<p>-9<p>-4/4</div>",
    "<div id=p1>-16</div><div id=p2><h1>+6</h1><p>+28<p>+28<p>+3<p>+50/8</div><div id=p3><h3>-2</h3><ul><li>-5/5<li>-6/6<li>-4/4</ul></div>",
    "<div><div><h1>+7</h1><p>+61<p>+14<p>+7<p>+42<h2>+3</h2><p>+55<p>+1</div><div><h3>-2</h3><p>-18/9<p>-21/12</div></div>",
    "<div>-3</div><div><h1>+5</h1><h2>+12</h2><p>+36<blockquote>+22</blockquote><p>+19<p>+83</div><div><ul><li>-1/1<li>-1/1<li>-1/1</ul></div>",
    "<section>-2/2</section><section><h1>+4</h1><p>+7<p>+13<p>+5<p>+9<p>+11</section><section>-6</section>",
    "<section>-8</section><section><p>+15<p>+4<p>+22<p>+3</section><section>-2/2</section><section>-9</section>",
    "<ul><li>-3/3<li>-2/2<li>-3/3</ul><div><p>+31/2<p>+46<p>+8</div><ul><li>-6/6<li>-7/7<li>-5/5<li>-8/8</ul><div>-17</div>",
    "<ol><li>-1/1<li>-1/1<li>-1/1</ol><div><h1>+6</h1><p>+39<ol><li>+14<li>+9<li>+21<li>+3</ol><p>+27<p>+2</div><div>-6/1</div>",
    "<dl><dt>-1/1<dt>-2/2</dl><dl><dt>+2<dd>+34<dt>+1<dd>+41<dt>+3<dd>+29</dl><dl><dt>-9</dl>",
    "<div class=h9>-5/4</div><div class=h8>-2</div><div class=h7><h1>+8</h1><p>+20<p>+1<p>+1<p>+60<p>+3</div><div class=h6>-7/6</div><div class=h5>-20</div>",
    "<div>-11/2</div><div><div><p>+25<p>+47</div><div><p>+33<p>+5</div><div><p>+70<p>+16/1</div></div><div>-4/4</div>",
    "<div class=t1><p>+5<p>+140<p>+3</div><div class=t2>-13/7</div>",
    "<div class=t1>-14/9</div><div class=t2><p>+4<p>+9<p>+130</div>",
    "<div class=t1><ul><li>-1/1<li>-2/2<li>-1/1</ul></div><div class=t2><h1>+9</h1><p>+9<p>+16<p>+38<p>+2/2<p>+47</div><div class=t3>-11</div>",
    # Sentences that are links as a whole, with text behind them.
    "<article><p>+88<p>+9/9<p>+6</article>",
    "<nav>-2/2</nav><article><h1>+5</h1><p>+70<p>+6/6<p>+4<p>+12</article><footer>-8</footer>",
    "<ul><li>-1/1<li>-1/1</ul><div class=k><h1>+7</h1><p>+60<p>+7/7<p>+6<p>+52</div><div>-9</div>",
    "<article><p>+45<p>+11/11<p>+3</article>",
    "<div class=k><p>+95<p>+8/8<p>+5<p>+7</div><div>-10</div>",
    "<article><h1>+6</h1><p>+77<p>+12/12<p>+9</article><footer>-7</footer>",
    "<div>-7</div><div><h1>+4</h1><p>+39<p>+58<p>+10/9<p>+2</div>",
    "<section><p>+120<p>+5/5<p>+11</section><section>-9</section>",
    "<main><h2>+5</h2><p>+64<p>+7/7<p>+8</main>",
    # Readers' posts and lists of further pages in containers without a telling name: much text, but behind and apart.
    "<ul><li>-1/1<li>-1/1</ul><div class=m1><h1>+6</h1><p>+57<p>+44<p>+63<p>+38</div><div class=m2><p>-2<p>-19<p>-1<p>-33</div><div>-9</div>",
    "<div class=m1><h1>+5</h1><p>+90<p>+72<p>+15</div><div class=m2><h3>-2</h3><p>-26<p>-4<p>-14</div>",
    "<div class=m1><p>+66<p>+81<p>+40</div><div class=m2><p>-14/6<p>-13/5<p>-16/7</div><div class=m3>-6</div>",
    "<div class=m0>-28</div><div class=m1><h1>+8</h1><p>+49<p>+53<p>+7<p>+60</div><div class=m2>-24</div><div class=m3>-10</div>",
    # Names that mislead: text in containers called after a side, a search, a share or a comment; forms around a whole page.
    "<form><div>-2/2</div><div>-1/1</div><div><h1>+6</h1><p>+64<p>+42<p>+5<p>+88</div><div>-9</div></form>",
    "<form><ul><li>-1/1<li>-1/1<li>-1/1</ul><div>-7</div><h1>+4</h1><p>+51<p>+73<p>+34</form>",
    "<div class='search content'><p>+90</div>",
    "<div class='side by side story'><p>+90</div>",
    "<ul><li>-1/1<li>-1/1</ul><div class='social entry'><h1>+5</h1><p>+30<p>+41</div><div>-8</div>",
    "<div class='nav-page'><p>+47<p>+59<p>+71/2<p>+3</div>",
    "<div id=sidebar-layout><div>-3/3</div><div><h1>+7</h1><p>+68<p>+2<p>+45<p>+31</div><div>-6</div></div>",
    "<div class='menu-open'><ul><li>-1/1<li>-1/1</ul><h1>+5</h1><p>+82<p>+37<p>+10<p>+54</div>",
    "<aside><h1>+6</h1><p>+77<p>+65<p>+12<p>+40</aside>",
    "<div class='promo-theme'><h1>+9</h1><p>+26<p>+8<p>+59<p>+33<p>+71</div><div>-7/7</div>",
    "<article><p>+44<p>+61<ul><li>-3/3<li>-4/4<li>-2/2<li>-5/5</ul></article>",
    "<article><h1>+5</h1><ul><li>-1/1<li>-1/1<li>-1/1</ul><p>+63<p>+28<p>+7</article>",
    "<main><div>-3/3</div><div>-2/2</div><div>-3/3</div><div><h1>+6</h1><p>+70<p>+35<p>+4</div><div>-4/4</div><div>-5/5</div></main>",
    "<main><h1>+4</h1><p>+52<p>+46<p>+2<ul><li>-6/6<li>-5/5<li>-7/7</ul></main><footer>-12</footer>",
    "<header>-3</header><main><ul><li>-2/2<li>-1/1<li>-2/2</ul><p>+58<p>+3<p>+40<p>+22</main><footer><p>-2/2<p>-10</footer>",
    # Readers' comments under their many names, in the text's own container and beside it.
    "<p>+50<p>+60<p>+30<div class=user-posts><p>-12<p>-20<p>-7<p>-31<p>-3</div>",
    "<div class=m1><p>+43<p>+57<p>+9<div class=responses><p>-14<p>-2<p>-25</div></div>",
    "<h1>+5</h1><p>+61<p>+37<p>+80<section class=discussion><p>-33<p>-8</section><div>-5</div>",
    "<article><h1>+7</h1><p>+55<p>+29</article><div class=feedback><p>-18<p>-21<p>-6</div>",
    # Tables and plain divisions without any hint: menus of links, columns of text, short lines in front and at the end.
    "<table><tr><td>-1/1<td>-2/2<td>-1/1<td>-2/2</table><h1>+5</h1><p>+62<p>+48/2<p>+3<p>+71<p>+36<div>-4</div><div>-3/3</div>",
    "<div>-2/2</div><div>-1/1</div><div>-3/3</div><div>-1/1</div><h2>+7</h2><p>+33<p>+54/5<p>+12<p>+80/4<div>-2/2</div><div>-5</div>",
    "<p>-6/6<p>-4/4<div>-9</div><h1>+8</h1><div>+44</div><div>+6</div><div>+38/3</div><div>+90</div><p>-12/10<p>-7",
    "<ul><li>-1/1<li>-1/1<li>-2/2<li>-1/1</ul><p>+104<p>+56<p>+18/2<p>+2<p>+67<ul><li>-3/3<li>-4/4<li>-2/2</ul><p>-8",
    "<center>-3</center><p>-5/5<h1>+6</h1><p>+29<p>+41<ul><li>+7<li>+9<li>+5</ul><p>+52/6<p>-2/2<p>-1/1<center>-6</center>",
    "<div>-1/1</div><div>-1/1</div><div>-11</div><div>-2/2</div><h1>+9</h1><p>+75/1<p>+22<p>+64<h3>+3</h3><p>+47<p>+31<div>-14/12</div><div>-3</div>",
    "<td>-1/1<td>-1/1<td>-1/1<td>+120/8<td>-2/2<td>-9/9<td>-2/2<td>-5",
    "<div>-4/4</div><div>-13</div><div>-3/3</div><p>+40<p>+4<p>+5<p>+58<p>+1<p>+45/2<div>-2/2</div><div>-1/1</div><div>-9</div>",
    "<div>-2</div><div>-1/1</div><div>-1/1</div><h1>+4</h1><p>+88<blockquote>+15</blockquote><p>+60/9<p>+17<p>+72<div>-6/6</div><div>-2/2</div><div>-4</div>",
    "<p>-2/2<p>-3/3<h1>+5</h1><p>+24/8<p>+41/16<p>+33/3<p>+29/14<p>+50/21<p>-4/4<p>-6/5",
    "<div>-1/1</div><div>-2/2</div><div>+60/30</div><div>+18/7</div><div>+45</div><div>+15/6</div><div>+36/13</div><div>-9/9</div>",
    "<p>-1/1<p>-10<p>-1/1<h2>+6</h2><p>+35<p>+27/3<p>+49<h2>+4</h2><p>+50<p>+8<p>+66<p>-5/4<p>-3",
    "<ol><li>-2/2<li>-3/3<li>-2/2</ol><h1>+10</h1><p>+25<ol><li>+12<li>+14<li>+11</ol><p>+39<p>-7/7<p>-2",
    "<div>-3/3</div><div>-7</div><div>-2/2</div><div>-15/13</div><p>+56<p>+43/4<p>+30<div>-8/8</div><div>-5</div>",
    "<table><tr><td>-1/1<td>-1/1</table><h1>+3</h1><table><tr><td>+3<td>+2<tr><td>+4<td>+1</table><p>+53<p>+34<p>-3/3<p>-6",
    "<div>-12</div><div>-1/1</div><div>-2/2</div><div>+47/3</div><div>+38</div><div>+21/1</div><div>+85</div><div>-2/2</div><div>-3/3</div>",
    # Articles: short paragraphs, linked sentences and class names that say nothing are part of them.
    "<nav><ul><li>-1/1<li>-1/1<li>-1/1</ul></nav><div class=ad>-8</div><article><h1>+8</h1><p>+1<p>+40<p>+2<p>+63/2<p>+55</article><footer>-9</footer>",
    "<nav>-2/2</nav><article><p>+104<p>+3<p>+12/12<p>+31</article>",
    "<nav>-3/3</nav><div class=banner>-14</div><main><h2>+3</h2><p>+70<ul><li>+3<li>+2</ul><p>+9/9<p>+1<p>+28/4</main><footer>-7</footer>",
    "<header>-2</header><nav>-5/5</nav><article class='news social'><h1>+5</h1><p>+33<p>+41/1<p>+6/6<p>+20</article><aside>-10</aside><footer>-3/3</footer>",
    "<div class=ad>-6</div><article><h1>+7</h1><p>+2<p>+1<p>+3</article><footer>-12</footer>",
    "<div class=ad>-11</div><article><p>+5</article><footer>-6</footer>",
    "<nav><ul><li>-2/2<li>-1/1</ul></nav><article><header><h1>+6</h1></header><p>+48<p>+5/5<p>+37<div class=promo>-12</div><p>+51<div class=share>-3</div></article><footer><p>-2/2<p>-11</footer>",
    "<nav>-1/1</nav><article><h1>+9</h1><p>+22<p>+7<aside>-13</aside><p>+45<p>+3<section id=comments><h3>-1</h3><p>-31<p>-4<p>-58</section></article>",
    "<article><p>+13<p>+60<p>+4<ul><li>+1/1<li>+6/6<li>+2</ul><p>+44</article><aside><p>-24<p>-3/3</aside><footer>-21</footer>",
    "<header><div>-3</div></header><article><h1>+5</h1><p>+81/40<p>+10/10<p>+35<form><label>-3</label><p>-16</form><p>+26</article><footer>-4/4</footer>",
    # Containers whose class or id says that they are something else, without an article.
    "<div class=menu>-1/1</div><div id=cookie-consent>-32</div><h1>+5</h1><p>+42<p>+57/2<div class=sidebar><p>-18<p>-41</div><div id=footer>-15</div>",
    "<div class=cookie-notice>-24</div><div id=nav>-6/6</div><div><p>+36<p>+9<p>+61</div><section class=comments><p>-45<p>-28<p>-6</section><div class=foot>-8</div>",
    "<div class=masthead>-4</div><div class=breadcrumbs>-5/4</div><h1>+11</h1><p>+59<p>+30/2<div class=newsletter>-19</div><p>+46<div class=related>-7/7</div><div class=related>-12/3</div>",
    "<div class=ads>-17</div><p>+38<p>+51<div class=sponsored-box>-36</div><p>+49<p>+65/3<div class=disqus>-27</div><div class=disqus>-52</div>",
    "<div class=login>-3</div><h1>+4</h1><p>+45<p>+6<p>+33<div class=widget><h4>-2</h4><p>-29</div><div class=pagination>-4/4</div><footer><p>-34</footer>",
    "<header>-8</header><div class=toolbar>-3</div><p>+77<p>+24<aside>-44<p>-26</aside><p>+58<form><p>-22</form><div class=alert>-13</div>",
    # Articles that end the page, and comments within them; links that are part of the text.
    "<nav>-2/2</nav><article><h1>+4</h1><p>+39<p>+18</article>",
    "<nav>-1/1</nav><div class=ad>-9</div><article><p>+27<p>+66<p>+2</article>",
    "<nav>-4/4</nav><main><p>+51<p>+7</main>",
    "<article><p>+35<p>+48<div class=comments><p>-22<p>-17</div></article>",
    "<article><p>+70<section class=replies><p>-9<p>-35</section></article>",
    "<article><h1>+6</h1><p>+44<aside>-3</aside><p>+23<section id=respond><p>-12<p>-64</section></article>",
    "<nav>-6/6</nav><article><h1>+3/3</h1><p>+2/2<p>+52/4<p>+1/1<p>+3/3<ul><li>+1/1<li>+2/2<li>+4/4</ul><p>+28</article><footer>-8</footer>",
    "<nav><ul><li>-1/1<li>-1/1</ul></nav><article><h1>+2/2</h1><p>+17<p>+1/1<p>+4/4<p>+46</article><footer><a>-2/2</footer>",
    "<article><p>+33<p>+3/3<p>+21/20<p>+2/2<p>+58</article><nav>-3/3</nav>",
    "<div>-3/3</div><div>-2/2</div><p>+18<p>+7<p>+40<p>+55/3<div>-2/2</div><div>-1/1</div>",
    "<div>-2/2</div><p>+20<p>+4<p>+33<div>-8/8</div><div>-6</div>",
    "<article><p>+30<p>+12</article>",
    "<nav>-2/2</nav><article><p>+44<p>+5</article>",
    "<main><h2>+5</h2><p>+20<p>+9</main>",
    "<nav>-1/1</nav><div class=ad>-10</div><article><h1>+4</h1><p>+25<p>+3<p>+14</article>",
    "<article><h1>+8</h1><p>+11<p>+16</article>",
    "<main><p>+48<p>+1</main>",
    # What is beside an article, without a hint.
    "<div>-2/2</div><div>-1/1</div><div>-7</div><article><h1>+5</h1><p>+30<p>+3<p>+47/2</article><div>-9</div>",
    "<div>-1/1</div><div>-14</div><article><h1>+7</h1><p>+1<p>+62<p>+28</article><div>-2/2</div><div>-11</div>",
    "<div>-3/3</div><div>-9</div><main><p>+55<p>+5<p>+37/3</main><div>-16</div>",
    "<div>-6</div><article><h1>+8</h1><p>+2<p>+74<p>+19</article><div>-21</div><div>-8</div>",
    "<p>-1/1<p>-12<article><h1>+6</h1><p>+43<p>+26</article><p>-33<p>-7/3<p>-4",
    "<p>-4/4<p>-5<article><p>+26<p>+4<p>+91</article><p>-13",
    "<div>-8</div><article><h1>+9</h1><p>+62<p>+5</article><div>-9</div>",
    "<p>-3/3<article><p>+30<p>+2</article><p>-6",
    "<article><h1>+4</h1><p>+8</article><div>-14</div>",
    "<div>-2/2</div><main><p>+41<p>+11</main><div>-4</div>",
    "<article><p>+3<p>+1</article><div>-27</div>",
    # Short paragraphs between long ones.
    "<p>+30<p>+4<p>+62<p>+2<p>+25<p>+6<p>+38",
    "<div>-2/2</div><p>+22<p>+7<p>+18<p>+3<p>+27<p>+1<p>+35<div>-1/1</div>",
    "<h1>+5</h1><p>+24<p>+5<p>+20<p>+8<p>+21/2<p>+2<p>+26<div>-3/3</div><div>-4</div>",
    "<div>-1/1</div><div>+19</div><div>+4</div><div>+23</div><div>+6</div><div>+34</div><div>+3</div><div>+29</div><div>-5/5</div>",
    # Text that ends the page.
    "<div>-1/1</div><div>-2/2</div><h1>+4</h1><p>+40<p>+60",
    "<p>-3/3<p>+33<p>+51/2<p>+12",
    "<h1>+5</h1><p>+44<p>+38/3<p>+70",
    "<p>+22<p>+9<p>+35",
    "<div>-2/2</div><div>+28</div><div>+47</div><div>+6</div><div>+54</div>",
    "<h2>+6</h2><p>+15<p>+4<p>+31/4<p>+80",
    "<div>-1/1</div><div>-8</div><div>-1/1</div><h1>+7</h1><p>+57<p>+26<p>+45",
    # A sentence or two alone, with nothing around.
    "<p>+9",
    "<p>+1",
    "<p>+4",
    "<p>+3<p>+6",
    "<h1>+2</h1><p>+14",
    "<p>+25/3",
    "<div class=ad>-6</div>",
    "<aside>-14</aside>",
    "<footer>-9</footer>",
]

@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    item: bool
    article: bool
    hint: int
    holder: int


@dataclass
class Page:
    """Blocks in page order, and of each container (0: the page) its parent, which has a smaller number, and how many containers
    around it, itself included, a name speaks against."""

    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    hints: list[int] = field(default_factory=lambda: [0])


@dataclass
class _State:
    """Where the reader stands: open holders (tag, number, what they add to the levels of articles and hints), and how many of each
    tag are open."""

    open: list[tuple[str, int, int, int]] = field(default_factory=list)
    count: Counter = field(default_factory=Counter)
    article: int = 0
    hint: int = 0
    link: int = 0
    tag: str = ""


def read(html: str) -> Page:
    page = Page()
    at, text, links = _State(), [], []

    def close_block() -> None:
        if text:
            words = "".join(text).split()
            if words:
                heading = len(at.tag) == 2 and at.tag[0] == "h" and at.tag[1].isdigit()
                flags = heading, at.tag in ("li", "dd", "dt", "td", "th"), at.article > 0, at.hint
                page.blocks.append(Block(" ".join(words), len(words), len("".join(links).split()), *flags, at.open[-1][1] if at.open else 0))
            text.clear()
            links.clear()

    skip = 0
    for m in TOKEN.finditer(html):
        if m.start() < skip:
            continue
        token = m.group()
        if token[0] != "<" or len(token) == 1 or not (token[1] in "/!?" or token[1].isalpha()):
            piece = unescape(token)
            text.append(piece)
            links.append(piece if at.link else " ")
            continue
        found = NAME.match(token)
        if not found:
            continue
        tag, closing = found.group(1).lower(), token[1] == "/"
        if tag in SILENT:
            if not closing and not token.endswith("/>"):
                end = re.compile(rf"</{tag}\b[^>]*>|<body\b" if tag == "head" else rf"</{tag}\b[^>]*>", re.I).search(html, m.end())
                skip = (end.start() if end.group()[1] != "/" else end.end()) if end else len(html)
            text.append(" ")
            links.append(" ")
        elif tag == "a":
            at.link = 0 if closing else 1
        elif tag == "br":
            text.append(" ")
            links.append(" ")
        elif tag in BLOCKS:
            close_block()
            at.link = 0
            at.tag = "" if closing else tag
            if tag in HOLDERS and not closing and not token.endswith("/>"):
                names = " ".join(x for y in LABELS.findall(token) for x in y)
                article = tag in ("article", "main")
                # What is named an article, or the whole page, isn't something else because of its other names.
                named = not article and tag != "body" and bool(HINTS.search(names)) and not TEXTS.search(names)
                hint = tag in BOILER or (tag == "header" and not at.article) or named
                page.parents.append(at.open[-1][1] if at.open else 0)
                at.open.append((tag, len(page.parents) - 1, int(article), int(hint)))
                at.count[tag] += 1
                at.article += article
                at.hint += hint
                page.hints.append(at.hint)
            elif closing and at.count[tag]:
                while at.open:
                    name, _, article, hint = at.open.pop()
                    at.count[name] -= 1
                    at.article -= article
                    at.hint -= hint
                    if name == tag:
                        break
    close_block()
    return page


def _main(page: Page) -> tuple[int, int, float]:
    """The innermost container with half of the page's unlinked words, in two blocks or more, as the range of its containers'
    numbers, with its share of them (0: it is the page). One that a name speaks against needs HINTED of the words; then the name, which holds for nearly all of the text, says
    nothing."""
    parents, n = page.parents, len(page.parents)
    words, blocks, last, depth = [0] * n, [0] * n, list(range(n)), [0] * n
    for b in page.blocks:
        words[b.holder] += b.words - b.linked
        blocks[b.holder] += b.words > b.linked
    for k in range(1, n):
        depth[k] = depth[parents[k]] + 1
    for k in range(n - 1, 0, -1):  # containers are numbered as they open
        words[parents[k]] += words[k]
        blocks[parents[k]] += blocks[k]
        last[parents[k]] = max(last[parents[k]], last[k])
    share = lambda k: HINTED if page.hints[k] else 0.5
    main = max((k for k in range(n) if k == 0 or (blocks[k] > 1 and words[k] >= share(k) * words[0])), key=lambda k: (depth[k], -k))
    return main, last[main], words[main] / max(1, words[0]) if main else 0.0


def features(page: Page) -> np.ndarray:
    """A row of FEATURES for each block; beyond either end there is a block without words."""
    found = page.blocks
    if not found:
        return np.zeros((0, len(FEATURES)))
    words, linked = (np.array([getattr(b, c) for b in found], float) for c in ("words", "linked"))
    main, last, contained = _main(page)
    inside = np.array([main <= b.holder <= last for b in found])
    flags = np.array([[b.heading, b.item, 0, b.article, b.hint] for b in found], float)
    flags[:, 4] = flags[:, 4] > np.where(inside, page.hints[main], 0)
    flags[:, 2] = 1 if not flags[:, 0].any() else np.maximum.accumulate(flags[:, 0])
    if flags[:, 3].any():  # an article, and what is not in it
        flags[:, 3] = 2 * flags[:, 3] - 1
    own = np.stack((words, linked / words), axis=1)
    near = np.pad(own, ((1, 1), (0, 0)))
    return np.hstack((own, near[:-2], near[2:], ~inside[:, None], np.full((len(found), 1), contained), flags))


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = LEAST) -> tuple:
    """A CART tree by Gini impurity: (feature, threshold, low, high), or (share of y,). Ties take the first feature."""
    if depth == 0 or len(y) < 2 * least or y.all() or not y.any():
        return (float(y.mean()) if len(y) else 0.0,)
    total, n = y.sum(), len(y)
    best, split = total * (1 - total / n) - 1e-9, None
    for k in range(x.shape[1]):
        order = np.argsort(x[:, k], kind="stable")
        values, ones = x[order, k], np.cumsum(y[order])
        cut = np.flatnonzero(values[1:] > values[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= n - least)]
        if len(cut):
            low = ones[cut - 1]
            cost = low * (1 - low / cut) + (total - low) * (1 - (total - low) / (n - cut))
            if cost.min() < best - 1e-12:
                at = cut[cost.argmin()]
                best, split = cost.min(), (k, float((values[at - 1] + values[at]) / 2))
    if split is None:
        return (float(y.mean()),)
    k, t = split
    low = x[:, k] <= t
    return (k, t, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def apply(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = apply(tree[2], x[low]), apply(tree[3], x[~low])
    return out


def labelled(pages: list[str] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    rows, marks = [], []
    for html in pages:
        page = read(html)
        for b in page.blocks:
            mark, words, linked = BLOCK.fullmatch(b.text).groups()
            b.words, b.linked = int(words), int(linked or 0)
            marks.append(mark == "+")
        rows.append(features(page))
    return np.vstack(rows), np.array(marks)


@cache
def tree() -> tuple:
    return grow(*labelled())


def main_text(html: str | None) -> str:
    page = read(html or "")
    keep = apply(tree(), features(page)) > 0.5
    return "\n".join(b.text for b, k in zip(page.blocks, keep.tolist(), strict=True) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind['page_id']}, url string, text string, n_chars long")
