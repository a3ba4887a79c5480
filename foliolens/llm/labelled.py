"""Labelled pages for the block classifier, written for this purpose.

Each text block begins with + (main text) or - (something else); {n} stands for n words.
"""

from __future__ import annotations

#: Pages whose elements, classes or ids say what their parts are, whatever the length of these.
NAMED_PAGES = [
    # Article element, menus and footer by element.
    "<nav><ul><li><a>-{1}</a><li><a>-{1}</a><li><a>-{2}</a></ul></nav><div class=ad>-{6}</div><article><h1>+{8}</h1><p><b>+{12}<br><p>+{30}</p>"
    "<p>+{60}</p><p>+{4}</p></article><footer>-{10}</footer>",
    "<nav><a>-{1}</a> <a>{1}</a></nav><article><h1>+{2}</h1><p>+{2}</p></article><footer>-{25}</footer>",
    "<header><h1>-{3}</h1><p>-{12}</p></header><main><h1>+{6}</h1><p>+{3}</p><p>+{80}</p><ul><li>+{5}</li><li>+{9}</li></ul></main><aside><h3>-{2}</h3>"
    "<p>-{40}</p></aside><footer><p>-{30}</p></footer>",
    "<header><a>-{2}</a></header><article><header><h1>+{7}</h1></header><p>+{45} <a>{3}</a></p><p>+{50}</p><h2>+{3}</h2><p>+{1}</p><p>+{35}</p><table><tr><td>+{2}"
    "<td>+{1}<tr><td>+{3}<td>+{1}</table><aside><p>-{20}</p></aside><p>+{22}</p><form><label>-{2}</label><p>-{15}</p></form></article>"
    "<section class=comments><h2>-{1}</h2><article><p>-{30}</p></article><article><p>-{55}</p></article></section><footer>-{9}</footer>",
    "<div class=cookie-notice><p>-{28}</p><button>-{1}</button></div><main><article><h1>+{5}</h1><p>+{20}</p><p>+{70}</p><div class=share><a>-{1}</a></div>"
    "<blockquote><p>+{18}</p></blockquote><p>+{33}</p></article></main><div id=comments><p>-{3}</p><p>-{24}</p><p>-{41}</p></div>",
    "<article><p>+{1}</p></article><div><p>-{14}</p></div><div><p>-{60}</p></div>",
    "<div><p>-{5}</p></div><article><h2>+{4}</h2><p>+{9}</p><ul><li><a>+{3}</a></li><li><a>+{6}</a></li></ul></article><div><p>-{35}</p><p>-{2}</p></div>",
    "<main><p>+{10} <a>{8}</a></p><p><a>+{5}</a></p><p>+{14}</p><div class=newsletter><p>-{18}</p></div><p>+{26}</p></main><div><h3>-{3}</h3><p>-{50}</p></div>",
    # Parts by class or id.
    "<div id=header><p>-{4}</p></div><div id=menu><a>-{1}</a><a> {1}</a></div><div id=content><h1>+{6}</h1><p>+{25}</p><p>+{55}</p><p>+{3}</p></div>"
    "<div id=sidebar><h4>-{2}</h4><p>-{30}</p><ul><li><a>-{4}</a><li><a>-{5}</a></ul></div><div id=footer><p>-{12}</p></div>",
    "<div class=navbar><ul><li><a>-{1}</a><li><a>-{1}</a></ul></div><div class=post-content><h2>+{5}</h2><p>+{40}</p><p>+{11}</p><div class=advert><p>-{25}</p></div>"
    "<p>+{38}</p></div><div class=related-posts><ul><li><a>-{7}</a><li><a>-{8}</a></ul></div><div class=site-footer>-{16}</div>",
    "<div class=entry><p>+{16}</p><pre>+{20}</pre><p>+{2}</p></div><div class=comment-list><p>-{32}</p><p>-{5}</p><p>-{64}</p></div>",
    "<div class=story><h1>+{9}</h1><p>+{27}</p><p>+{48}</p></div><div><p>-{22}</p></div><div class=promo><p>-{45}</p></div>",
    "<article><h1>+{5}</h1><p>+{4}</p><p><a>+{3}</a></p><p>+{5}</p><p><a>+{6}</a> {2}</p><p>+{7}</p><p>+{4}</p></article>",
    "<nav><a>-{2}</a></nav><main><h2>+{3}</h2><p>+{5} <a>{5}</a></p><p>+{6}</p><ul><li><a>+{2}</a><li><a>+{4}</a></ul><p>+{5}</p></main>",
    "<div class=content><p>+{6}</p><p>+{2}</p><p><a>+{3}</a></p><p>+{6}</p><p>+{3}</p></div>",
    "<article><p>+{5}</p></article>",
    "<article><h2>+{2}</h2><p>+{3}</p><h2>+{4}</h2><p>+{4}</p><p>+{2} <a>{2}</a></p><p>+{5}</p></article>",
    "<main><ul><li><a>+{3}</a> {3}<li>+{4} <a>{2}</a></ul><p>+{5}</p><ul><li>+{3}<li><a>+{3}</a></ul><p>+{2}</p></main>",
]

#: Pages without such names, where words and links decide.
PLAIN_PAGES = [
    "<div><a>-{1}</a> <a>{1}</a> <a>{2}</a></div><div><h1>+{7}</h1><p>+{35}</p><p>+{60}</p><p>+{28}</p></div><div><a>-{3}</a> <a>{4}</a></div><div>-{6}</div>",
    "<table><tr><td><a>-{2}</a><td><a>-{1}</a></table><h2>+{6}</h2><p>+{22}</p><p>+{8}</p><p>+{41}</p><p>+{19}</p><p><a>-{3}</a></p><p>-{5}</p>",
    "<ul><li><a>-{2}</a><li><a>-{3}</a><li><a>-{1}</a></ul><p>+{50}</p><p>+{26} <a>{3}</a> {8}</p><p>+{72}</p><p>+{31}</p><ul><li><a>-{5}</a><li><a>-{6}</a><li><a>-{4}</a></ul><p>-{4}</p>",
    "<div><a>-{4}</a></div><div><a>-{2}</a></div><h1>+{5}</h1><p>+{18}</p><p>+{90}</p><h2>+{3}</h2><p>+{44}</p><div>-{3}</div><div><a>-{2}</a></div><div>-{5}</div>",
    "<p><a>-{2}</a> | <a>{2}</a></p><p>+{34}</p><p>+{15}</p><p>+{29}</p><p>+{120}</p><p>-{7}</p><p><a>-{9}</a></p>",
    "<div>-{2}</div><div><a>-{1}</a><a> {1}</a></div><div><p>+{24}</p><p>+{58}</p></div><div><a>-{6}</a></div><div><a>-{7}</a></div><div>-{8}</div>",
    "<h1>+{6}</h1><p>+{65}</p><p>+{40}</p>",
    "<p>+{12}</p><p>+{33}</p>",
    "<div><a>-{2}</a></div><div><a>-{1}</a></div><div><a>-{1}</a></div>",
    "<div><a>-{3}</a> {1}</div><div>-{2}</div><div>-{3}</div>",
    "<div><a>-{2}</a></div><h1>+{8}</h1><p>+{42}</p><p>+{6}</p><p>+{51}</p><p>+{4}</p><p>+{37}</p><h3>-{2}</h3><ul><li><a>-{8}</a><li><a>-{11}</a><li><a>-{9}</a></ul><div>-{6}</div>",
    "<div>-{3}</div><div><a>-{1}</a> | <a>{1}</a> | <a>{2}</a></div><h2>+{7}</h2><p>+{29}</p><p>+{7}</p><p>+{46}</p><p>+{33}</p><div><a>-{2}</a> {2}</div><div>-{4}</div>",
    "<div><a>-{12}</a></div><div><a>-{10}</a></div><div><a>-{14}</a></div><h1>+{5}</h1><p>+{38}</p><p>+{3}</p><p>+{27}</p><div><a>-{13}</a></div><div><a>-{11}</a></div><div>-{9}</div>",
    "<h3>-{2}</h3><ul><li><a>-{4}</a><li><a>-{5}</a></ul><h1>+{9}</h1><p>+{64}</p><p>+{8}</p><p>+{8}</p><p>+{31}</p><h3>-{3}</h3><ul><li><a>-{6}</a><li><a>-{3}</a></ul>",
    "<div>-{4}</div><h1>+{6}</h1><p>+{21}</p><ul><li>+{6}</li><li>+{5}</li><li>+{8}</li></ul><p>+{36}</p><p>+{5}</p><p>+{48}</p><div>-{5}</div><div><a>-{2}</a></div>",
    "<div><a>-{1}</a></div><div>-{2} <a>{1}</a></div><h1>+{4}</h1><h2>+{11}</h2><p>+{52}</p><h2>+{3}</h2><p>+{39}</p><h2>+{4}</h2><p>+{68}</p><h4>-{2}</h4><div><a>-{3}</a></div><div><a>-{4}</a></div>",
    "<div><a>-{3}</a><a> {2}</a></div><p>+{25} <a>{2}</a> {14}</p><p>+{9}</p><p>+{44} <a>{4}</a></p><p><a>-{3}</a> {1} <a>{3}</a></p><div>-{7}</div><div>-{3}</div>",
    "<div>-{1}</div><div>-{2}</div><div>-{1}</div><h1>+{7}</h1><p>+{58}</p><p>+{47}</p><div>-{1}</div><div>-{2}</div><div>-{8}</div>",
    "<div><a>-{5}</a> {2}</div><div><a>-{6}</a> {1}</div><p>+{41}</p><p>+{2}</p><p>+{40}</p><p>+{9}</p><p>+{62}</p><div>-{2} <a>{5}</a></div><div>-{3} <a>{6}</a></div>",
    "<ul><li>-{1}<li>-{2}<li>-{1}</ul><h1>+{6}</h1><p>+{32}</p><p>+{76}</p><blockquote>+{7}</blockquote><p>+{28}</p><ul><li><a>-{1}</a><li><a>-{2}</a></ul>",
    "<p>+{55}</p><p>+{9}</p><p>+{49}</p><p>+{12}</p><p>+{7}</p><p>+{60}</p>",
    "<h1>+{3}</h1><p>+{17}</p><h2>+{2}</h2><p>+{23}</p><h2>+{5}</h2><p>+{8}</p><p>+{19}</p>",
    "<div><a>-{2}</a><a> {2}</a></div><h1>+{6}</h1><p>+{20} <a>{6}</a> {10}</p><p>+{14} <a>{5}</a> {4} <a>{4}</a></p><p>+{110}</p><p>+{6}</p><p>+{95}</p><p>+{24}</p><div>-{5}</div>",
    "<p>+{85}</p><p>+{130}</p><p>+{18} <a>{8}</a> {5}</p><p>+{90}</p><p>+{8}</p><p>+{100}</p><p>+{16}</p><div><a>-{3}</a> {2} <a>{4}</a></div>",
    "<h2>+{5}</h2><p>+{9} <a>{3}</a> {6}</p><p>+{24}</p><p>+{30} <a>{12}</a></p><p>+{50}</p><div>-{2} <a>{3}</a> {1} <a>{2}</a></div><div>-{1} <a>{4}</a></div><div>-{3}</div>",
    "<div><a>-{7}</a> {4}</div><div><a>-{8}</a> {5}</div><div><a>-{6}</a> {6}</div><h1>+{8}</h1><p>+{140}</p><p>+{11}</p><p>+{26} <a>{9}</a> {3}</p><p>+{75}</p><div>-{3} <a>{3}</a> {1}</div>",
    "<p>+{200}</p><p>+{15}</p><p>+{160}</p><p>+{6}</p><p>+{180}</p><div>-{4}</div><div><a>-{1}</a></div>",
]
