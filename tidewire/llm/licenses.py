"""License scans: ordered signature rules behind a keyword prefilter.

Hundreds of regular expressions are written per license in ``LICENSES`` below and put in an order: a rule's kind gives
its priority and confidence. A text, its white space made single spaces, is first searched for the rules' keywords; a
rule then runs only around the places of its keyword, as far as a match can reach. Of the detections in a text, one that lies within the span of a detection of higher priority (or of the same
priority and longer, or first) is suppressed. What remains gives the labels and the score.

The base phrases are exact: places where their words stand consecutively; their labels always stay.

Nulls and edge cases: a null text is an empty one; a null id is kept; repeated rows are scanned each; texts are
scanned whole, whatever their length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import importable, read_table
from .textkernel import batches_by_bytes, words

#: Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_SPACE = re.compile(r"\s+")
_V = r"(?:,?\s*(?:version|v\.?)?\s*)"
#: label | names (regexes of a title) | SPDX identifiers | URLs | phrases of the license's own text
LICENSES = r"""
mit | (?:the\s+)?mit(?:/x11|\s+\(expat\))?\s+licen[cs]e ; expat\s+licen[cs]e ; x11\s+licen[cs]e | mit ; mit-0 ; x11 | opensource\.org/licenses?/mit ; mit-license\.org | permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+obtaining ; the\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+shall\s+be\s+included
apache-2.0 | apache\s+(?:software\s+)?licen[cs]e{v}2(?:\.0)? ; apache[\s-]+2(?:\.0)?\s+licen[cs]e ; asl\s+2\.0 | apache-2\.0 | apache\.org/licenses/license-2\.0 ; opensource\.org/licenses?/apache-2\.0 | unless\s+required\s+by\s+applicable\s+law\s+or\s+agreed\s+to\s+in\s+writing ; you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+license
apache-1.1 | apache\s+(?:software\s+)?licen[cs]e{v}1\.1 | apache-1\.1 | apache\.org/licenses/license-1\.1 | this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+apache\s+software\s+foundation
apache | (?:the\s+)?apache\s+(?:software\s+)?licen[cs]e | apache-1\.0 | apache\.org/licenses | licensed\s+to\s+the\s+apache\s+software\s+foundation
agpl-3.0 | (?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e{v}3(?:\.0)? ; agpl\s*v?3 | agpl-3\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/agpl ; opensource\.org/licenses?/agpl-3 | remote\s+network\s+interaction ; interacting\s+with\s+it\s+remotely\s+through\s+a\s+computer\s+network
agpl | (?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e ; \bagpl\b | agpl-1\.0 | affero\.org/oagpl | gnu\s+affero
lgpl-3.0 | (?:gnu\s+)?lesser\s+general\s+public\s+licen[cs]e{v}3(?:\.0)? ; lgpl\s*v?3 | lgpl-3\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/lgpl-3 ; opensource\.org/licenses?/lgpl-3 | combined\s+work\s+under\s+terms\s+of\s+your\s+choice
lgpl-2.1 | (?:gnu\s+)?lesser\s+general\s+public\s+licen[cs]e{v}2\.1 ; lgpl\s*v?2\.1 | lgpl-2\.1(?:-only|-or-later)?\+? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1 ; opensource\.org/licenses?/lgpl-2\.1 | work\s+that\s+uses\s+the\s+library
lgpl-2.0 | (?:gnu\s+)?library\s+general\s+public\s+licen[cs]e(?:{v}2(?:\.0)?)? ; lgpl\s*v?2(?:\.0)?\b | lgpl-2\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0 | gnu\s+library\s+general\s+public
lgpl | (?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[cs]e ; \blgpl\b | lgpl | gnu\.org/(?:licenses|copyleft)/lesser | this\s+library\s+is\s+free\s+software
gpl-3.0 | (?:gnu\s+)?general\s+public\s+licen[cs]e{v}3(?:\.0)? ; \bgpl\s*[-v]*\s*3(?:\.0)? | gpl-3\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/gpl-3 ; opensource\.org/licenses?/gpl-3 | either\s+version\s+3\s+of\s+the\s+license ; no\s+covered\s+work\s+shall\s+be\s+deemed\s+part\s+of\s+an\s+effective\s+technological\s+measure
gpl-2.0 | (?:gnu\s+)?general\s+public\s+licen[cs]e{v}2(?:\.0)? ; \bgpl\s*[-v]*\s*2(?:\.0)? | gpl-2\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/(?:old-licenses/)?gpl-2 ; opensource\.org/licenses?/gpl-2 | either\s+version\s+2\s+of\s+the\s+license ; as\s+published\s+by\s+the\s+free\s+software\s+foundation;\s+version\s+2
gpl-1.0 | (?:gnu\s+)?general\s+public\s+licen[cs]e{v}1(?:\.0)? | gpl-1\.0(?:-only|-or-later)?\+? | gnu\.org/licenses/old-licenses/gpl-1 | either\s+version\s+1,?\s+or
gpl | (?:gnu\s+)?general\s+public\s+licen[cs]e ; gnu\s+gpl ; \bgplv?\b | gpl ; gpl\+ | gnu\.org/(?:licenses|copyleft)/gpl | under\s+the\s+terms\s+of\s+the\s+gnu
bsd-4-clause | (?:original|4[\s-]clause|four[\s-]clause)\s+bsd\s+licen[cs]e ; bsd\s+4[\s-]clause | bsd-4-clause(?:-uc)? | spdx\.org/licenses/bsd-4-clause | all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use
bsd-3-clause | (?:new|modified|revised|3[\s-]clause|three[\s-]clause)\s+bsd(?:\s+licen[cs]e)? ; bsd\s+3[\s-]clause | bsd-3-clause(?:-clear|-lbnl)? | opensource\.org/licenses?/bsd-3-clause | neither\s+the\s+name\s+of\s+.{1,120}?\s+nor\s+the\s+names\s+of\s+its\s+contributors
bsd-2-clause | (?:simplified|freebsd|2[\s-]clause|two[\s-]clause)\s+(?:bsd\s+)?licen[cs]e ; bsd\s+2[\s-]clause | bsd-2-clause(?:-patent|-views)? | opensource\.org/licenses?/bsd-2-clause | redistributions\s+of\s+source\s+code\s+must\s+retain\s+the\s+above\s+copyright
bsd | bsd[\s-](?:style\s+)?licen[cs]e ; berkeley\s+software\s+distribution\s+licen[cs]e | bsd | opensource\.org/licenses?/bsd-license | redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms
0bsd | (?:bsd\s+)?zero[\s-]clause\s+(?:bsd\s+)?licen[cs]e ; 0bsd\s+licen[cs]e | 0bsd | opensource\.org/licenses?/0bsd | to\s+use,\s+copy,\s+modify,\s+and/or\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee\s+is\s+hereby\s+granted\.\s+the\s+software
isc | isc\s+licen[cs]e ; internet\s+(?:systems|software)\s+consortium\s+licen[cs]e | isc | opensource\.org/licenses?/isc ; isc\.org/licenses | permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose
mpl-2.0 | mozilla\s+public\s+licen[cs]e{v}2(?:\.0)? ; mpl\s*v?2(?:\.0)? | mpl-2\.0(?:-no-copyleft-exception)? | mozilla\.org/(?:en-us/)?mpl/2\.0 ; opensource\.org/licenses?/mpl-2\.0 | this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms
mpl-1.1 | mozilla\s+public\s+licen[cs]e{v}1\.1 ; mpl\s*v?1\.1 | mpl-1\.1 | mozilla\.org/mpl/(?:mpl-)?1\.1 | the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+mozilla
mpl | mozilla\s+public\s+licen[cs]e | mpl-1\.0 | mozilla\.org/mpl | netscape\s+communications\s+corporation
epl-2.0 | eclipse\s+public\s+licen[cs]e{v}2(?:\.0)? ; epl\s*v?2(?:\.0)? | epl-2\.0 | eclipse\.org/legal/epl-(?:2\.0|v20) ; eclipse\.org/org/documents/epl-2\.0 | secondary\s+licenses\s+when\s+the\s+conditions
epl-1.0 | eclipse\s+public\s+licen[cs]e{v}1(?:\.0)? ; epl\s*v?1(?:\.0)? | epl-1\.0 | eclipse\.org/legal/epl-v10 ; opensource\.org/licenses?/eclipse-1\.0 | accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse
epl | eclipse\s+public\s+licen[cs]e ; eclipse\s+distribution\s+licen[cs]e | edl-1\.0 | eclipse\.org/org/documents/edl | eclipse\s+foundation\s+software\s+user\s+agreement
cddl-1.0 | common\s+development\s+and\s+distribution\s+licen[cs]e(?:{v}1(?:\.[01])?)? ; \bcddl\b(?:\s*v?1\.[01])? | cddl-1\.[01] | opensource\.org/licenses?/cddl | glassfish\.dev\.java\.net/public/cddl ; subject\s+to\s+the\s+terms\s+of\s+the\s+common\s+development
cpl-1.0 | common\s+public\s+licen[cs]e(?:{v}1(?:\.0)?)? | cpl-1\.0 | opensource\.org/licenses?/cpl | accompanying\s+program\s+is\s+provided\s+under\s+the\s+terms\s+of\s+this\s+common\s+public
artistic-2.0 | artistic\s+licen[cs]e{v}2(?:\.0)? | artistic-2\.0 | perlfoundation\.org/artistic.license.2.0 ; opensource\.org/licenses?/artistic-2 | standard\s+version\s+of\s+the\s+package
artistic-1.0 | artistic\s+licen[cs]e(?:{v}1(?:\.0)?)? ; same\s+terms\s+as\s+perl\s+itself | artistic-1\.0(?:-perl|-cl8)? | opensource\.org/licenses?/artistic-1 ; dev\.perl\.org/licenses | freely\s+available.\s+means\s+that\s+no\s+fee
zlib | zlib(?:/libpng)?\s+licen[cs]e ; libpng\s+licen[cs]e | zlib ; libpng(?:-2\.0)? | opensource\.org/licenses?/zlib ; zlib\.net/zlib_license | altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked ; provided\s+.as-is.,\s+without\s+any\s+express\s+or\s+implied\s+warranty
bsl-1.0 | boost\s+software\s+licen[cs]e(?:{v}1(?:\.0)?)? | bsl-1\.0 | boost\.org/license_1_0 ; opensource\.org/licenses?/bsl-1\.0 | machine-executable\s+object\s+code\s+generated\s+by\s+a\s+source\s+language\s+processor
unlicense | (?:the\s+)?unlicense\b | unlicense | unlicense\.org | free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain
wtfpl | do\s+what\s+the\s+f.{{1,4}}\s+you\s+want\s+to\s+public\s+licen[cs]e ; \bwtfpl\b | wtfpl | wtfpl\.net ; sam\.zoy\.org/wtfpl | you\s+just\s+do\s+what\s+the
ms-pl | microsoft\s+public\s+licen[cs]e ; \bms-pl\b | ms-pl | opensource\.org/licenses?/ms-pl | distribute\s+any\s+portion\s+of\s+the\s+software\s+in\s+source\s+code\s+form,\s+you\s+may\s+do\s+so\s+only\s+under\s+this\s+license
ms-rl | microsoft\s+reciprocal\s+licen[cs]e ; \bms-rl\b | ms-rl | opensource\.org/licenses?/ms-rl | reciprocal\s+grants
eupl-1.2 | european\s+union\s+public\s+licen[cs]e(?:{v}1(?:\.2)?)? ; \beupl\b(?:\s*v?1\.[0-2])? | eupl-1\.[0-2] | joinup\.ec\.europa\.eu/.{{0,40}}eupl ; eupl\.eu | licensed\s+under\s+the\s+eupl
osl-3.0 | open\s+software\s+licen[cs]e(?:{v}3(?:\.0)?)? | osl-[123]\.[01] | opensource\.org/licenses?/osl-3 | licensed\s+under\s+the\s+open\s+software\s+license
afl-3.0 | academic\s+free\s+licen[cs]e(?:{v}3(?:\.0)?)? | afl-[123]\.[012] | opensource\.org/licenses?/afl-3 | licensed\s+under\s+the\s+academic\s+free\s+license
qpl-1.0 | q\s+public\s+licen[cs]e(?:{v}1(?:\.0)?)? | qpl-1\.0 | opensource\.org/licenses?/qtpl ; opensource\.org/licenses?/qpl | licensed\s+under\s+the\s+q\s+public\s+license
python-2.0 | python\s+software\s+foundation\s+licen[cs]e ; python\s+licen[cs]e(?:{v}2(?:\.0)?)? ; psf\s+licen[cs]e | python-2\.0 ; psf-2\.0 | docs\.python\.org/.{{0,12}}license ; opensource\.org/licenses?/python-2 | psf\s+is\s+making\s+python\s+available
php-3.01 | php\s+licen[cs]e(?:{v}3(?:\.0?1)?)? | php-3\.0?1? | php\.net/license | this\s+product\s+includes\s+php\s+software
ruby | ruby\s+licen[cs]e ; same\s+terms\s+as\s+ruby(?:\s+itself)? | ruby | ruby-lang\.org/.{{0,20}}license | place\s+your\s+modifications\s+in\s+the\s+public\s+domain\s+or\s+otherwise\s+make\s+them\s+freely\s+available
openssl | openssl\s+licen[cs]e ; ssleay\s+licen[cs]e | openssl | openssl\.org/source/license | developed\s+by\s+the\s+openssl\s+project
postgresql | postgresql\s+licen[cs]e | postgresql | opensource\.org/licenses?/postgresql ; postgresql\.org/about/licence | in\s+no\s+event\s+shall\s+the\s+university\s+of\s+california
ncsa | (?:university\s+of\s+illinois/)?ncsa\s+open\s+source\s+licen[cs]e | ncsa | opensource\.org/licenses?/ncsa ; opensource\.org/licenses?/uoi-ncsa | deal\s+with\s+the\s+software\s+without\s+restriction
ofl-1.1 | (?:sil\s+)?open\s+font\s+licen[cs]e(?:{v}1(?:\.1)?)? | ofl-1\.[01](?:-rfn|-no-rfn)? | scripts\.sil\.org/ofl ; openfontlicense\.org | reserved\s+font\s+name
cc0-1.0 | creative\s+commons\s+zero(?:\s+v?1(?:\.0)?)? ; \bcc0\b(?:\s*1\.0)? | cc0-1\.0 | creativecommons\.org/publicdomain/zero | waive[sd]?\s+all\s+(?:of\s+)?(?:his|her|their|its|your)?\s*(?:rights|copyright)
cc-by-nc-sa | creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+share-?alike ; by-nc-sa | cc-by-nc-sa-[1-4]\.[05] | creativecommons\.org/licenses/by-nc-sa | attribution-noncommercial-sharealike\s+[1-4]
cc-by-nc-nd | creative\s+commons\s+attribution[\s-]+non-?commercial[\s-]+no-?deriv(?:ative)?s(?:\s+works)? ; by-nc-nd | cc-by-nc-nd-[1-4]\.[05] | creativecommons\.org/licenses/by-nc-nd | attribution-noncommercial-noderivatives\s+[1-4]
cc-by-nc | creative\s+commons\s+attribution[\s-]+non-?commercial ; by-nc(?![\w-]) | cc-by-nc-[1-4]\.[05] | creativecommons\.org/licenses/by-nc/ | attribution-noncommercial\s+[1-4]
cc-by-nd | creative\s+commons\s+attribution[\s-]+no-?deriv(?:ative)?s ; by-nd | cc-by-nd-[1-4]\.[05] | creativecommons\.org/licenses/by-nd | attribution-noderivatives\s+[1-4]
cc-by-sa | creative\s+commons\s+attribution[\s-]+share-?alike ; by-sa | cc-by-sa-[1-4]\.[05] | creativecommons\.org/licenses/by-sa | attribution-sharealike\s+[1-4]
cc-by | creative\s+commons\s+attribution ; cc-by(?![\w-]) | cc-by-[1-4]\.[05] | creativecommons\.org/licenses/by/ | attribution\s+[1-4]\.0\s+international
creative-commons | creative\s+commons(?:\s+licen[cs]e)? | cc-pddc | creativecommons\.org | some\s+rights\s+reserved
odbl-1.0 | open\s+(?:data\s+commons\s+open\s+)?database\s+licen[cs]e ; \bodbl\b | odbl-1\.0 | opendatacommons\.org/licenses/odbl | any\s+rights\s+in\s+individual\s+contents\s+of\s+the\s+database
pddl-1.0 | public\s+domain\s+dedication\s+and\s+licen[cs]e | pddl-1\.0 | opendatacommons\.org/licenses/pddl | dedicate\s+the\s+work\s+to\s+the\s+public\s+domain
ogl-3.0 | open\s+government\s+licen[cs]e(?:{v}[123](?:\.0)?)? | ogl-uk-[123]\.0 | nationalarchives\.gov\.uk/doc/open-government-licence | contains\s+public\s+sector\s+information\s+licensed
gfdl-1.3 | (?:gnu\s+)?free\s+documentation\s+licen[cs]e(?:{v}1\.[123])? ; \bgfdl\b | gfdl-1\.[123](?:-only|-or-later)? | gnu\.org/(?:licenses|copyleft)/fdl | with\s+no\s+invariant\s+sections
public-domain | released\s+(?:in)?to\s+the\s+public\s+domain ; (?:in|placed\s+in)\s+the\s+public\s+domain | publicdomain | creativecommons\.org/publicdomain/mark | public\s+domain
busl-1.1 | business\s+source\s+licen[cs]e(?:{v}1(?:\.1)?)? | busl-1\.1 | mariadb\.com/bsl11 | additional\s+use\s+grant
sspl-1.0 | server\s+side\s+public\s+licen[cs]e(?:{v}1)? ; \bsspl\b | sspl-1\.0 | mongodb\.com/licensing/server-side-public-license | offering\s+the\s+program\s+as\s+a\s+service
elastic-2.0 | elastic\s+licen[cs]e(?:{v}2(?:\.0)?)? | elastic-2\.0 | elastic\.co/licensing/elastic-license | hosted\s+or\s+managed\s+service
openrail | (?:big\s*science|creativeml)\s+open\s*rail(?:[\s-]m)?(?:\s+licen[cs]e)? ; open\s*rail[\s-]m | openrail(?:-m)? ; creativeml-openrail-m | huggingface\.co/spaces/.{{0,40}}license | use-based\s+restrictions
proprietary | all\s+rights\s+reserved ; proprietary\s+and\s+confidential | licenseref-proprietary | example\.com/eula | end[\s-]user\s+licen[cs]e\s+agreement ; unauthorized\s+copying\s+of\s+this\s+file
"""

#: Kinds of rules, the first with the highest priority: how a regex is made from a license's entry, and its confidence.
KINDS = {
    "identifier": (r"spdx-license-identifier:\s*(?:{})(?![\w.-])", 0.99),
    "link": (r"(?:https?://)?(?:www\.)?{}\S*", 0.95),
    "grant": (r"(?:licen[cs]ed|released|distributed|available|redistributed?|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?(?:{})", 0.95),
    "title": (r"(?<![\w-])(?:{})", 0.8),
    "text": (r"{}", 0.7),
}
@dataclass(frozen=True)
class Rule:
    """``before`` and ``after`` are the most characters of a match on either side of its keyword; a link goes on to the next space."""

    label: str
    priority: int
    confidence: float
    keyword: str
    regex: re.Pattern
    before: int
    after: int
    link: bool


def keyword(pattern: str) -> tuple[str, int]:
    """The longest run of letters that every match of a pattern holds, outside its groups, choices and classes; and where in the pattern it begins."""
    depth, i = 0, 0
    plain: list[tuple[str, int]] = []
    while i < len(pattern):
        at, c = i, pattern[i]
        if c == "[":
            i = pattern.index("]", i)
            c = ""
        if c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        if c == "\\":
            i += 1
            c = pattern[i] if pattern[i] in "-/" else ""
        if c and c in "?*{":
            plain = plain[:-1]
        plain.append((c if c.isalpha() and not depth else "\0", at))
        if c == "{":
            i = pattern.index("}", i)
        i += 1
    found = max(re.finditer("[a-z]+", "".join(c for c, _ in plain)), key=lambda m: m.end() - m.start(), default=None)
    return (found[0], plain[found.start()][1]) if found else ("", 0)


def _most(pattern: str) -> int:
    """The most characters that a pattern can match."""
    return int(re._parser.parse(pattern).getwidth()[1])


def _rule(label: str, priority: int, confidence: float, form: str, name: str) -> Rule:
    word, at = ("spdx", 0) if form.startswith("spdx") else keyword(name)
    whole, link = form.format(name), form.endswith(r"\S*")
    before = 0 if form.startswith("spdx") else _most(form[: form.index("{}")].removesuffix("(?:")) + _most(name[:at])
    return Rule(label, priority, confidence, word, re.compile(whole), before, _most(whole.removesuffix(r"\S*")) - len(word), link)


def _single(pattern: str) -> str:
    """A pattern for texts whose white space is single spaces: every match has a bounded length."""
    return pattern.replace(r"[\s-]+", r"[\s-]{1,4}").replace("[-v]*", "[-v]{0,4}").replace(r"\s+", r"\s").replace(r"\s*", r"\s?")


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, by priority."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, names, ids, links, texts = (x.strip() for x in line.split(" | "))
        parts = lambda field: [_single(x.strip().replace("{v}", _V).replace("{{", "{").replace("}}", "}")) for x in field.split(" ; ")]
        entries = {"identifier": ["|".join(parts(ids))], "link": parts(links), "grant": parts(names), "title": parts(names), "text": parts(texts)}
        for priority, (kind, (form, confidence)) in enumerate(KINDS.items()):
            out += [_rule(label, priority, confidence, _single(form), p) for p in entries[kind]]
    return tuple(sorted(out, key=lambda r: r.priority))


@lru_cache(maxsize=1)
def _priorities() -> np.ndarray:
    return np.array([r.priority for r in rules()], np.int64)


@lru_cache(maxsize=1)
def _prefilter():
    """An automaton of all keywords, each with the numbers of its rules."""
    import ahocorasick

    by_word: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        by_word.setdefault(rule.keyword, []).append(i)
    out = ahocorasick.Automaton()
    for word, numbers in by_word.items():
        out.add_word(word, tuple(numbers))
    out.make_automaton()
    return out


def _uncovered(priority: np.ndarray, spans: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Which detections lie within none of higher rank: of a smaller priority, or of the same one and longer or first.

    A detection within a suppressed one lies within what suppresses that, too, so all may be compared with all: a sweep
    over the starts keeps the furthest end so far.
    """
    start, end = spans[:, 0], spans[:, 1]
    out = np.zeros(len(start), bool)
    order = np.lexsort((nth, -end, start))
    for p in np.unique(priority):
        mine = order[priority[order] == p]
        furthest = np.maximum.accumulate(end[mine])
        covered = np.concatenate([[False], furthest[:-1] >= end[mine][1:]])
        higher = order[priority[order] < p]
        if len(higher):
            at = np.searchsorted(start[higher], start[mine], "right")
            reach = np.concatenate([[-1], np.maximum.accumulate(end[higher])])
            covered |= reach[at] >= end[mine]
        out[mine] = ~covered
    return out


def _matches(rule: Rule, text: str, ends: list[int]) -> Iterator[tuple[int, int]]:
    """The spans of a rule's matches one after another, searched only around the ends of its keyword."""
    at, n, search = 0, len(rule.keyword), rule.regex.search
    for k in ends:
        if k - n < at:
            continue  # in the match before
        stop = k + rule.after + 1
        if rule.link and (stop := text.find(" ", stop)) < 0:
            stop = len(text)
        m = search(text, max(at, k - n - rule.before), stop)
        if m:
            at = m.end()
            yield m.span()


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """Detections in a text (A-Z in lower case) that no other one of at least their rank contains, by rank.

    Places are those in the text with every run of white space as one space.
    """
    text = _SPACE.sub(" ", text)
    places: dict[tuple[int, ...], list[int]] = {}
    for end, numbers in _prefilter().iter(text):
        places.setdefault(numbers, []).append(end + 1)
    spans: list[tuple[int, int]] = []
    nths: list[int] = []
    for numbers, ends in places.items():
        for nth in numbers:
            new = list(_matches(rules()[nth], text, ends))
            spans += new
            nths += [nth] * len(new)
    if not spans:
        return []
    spans, nth = np.array(spans, np.int64), np.array(nths, np.int64)
    priority = _priorities()[nth]
    kept = np.flatnonzero(_uncovered(priority, spans, nth))
    kept = kept[np.lexsort((nth[kept], spans[kept, 0], spans[kept, 0] - spans[kept, 1], priority[kept]))]
    return [(a, b, rules()[i]) for (a, b), i in zip(spans[kept].tolist(), nth[kept].tolist())]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = [(p.encode().split(), label) for p, label in PHRASES]
    for batch in batches_by_bytes(batches, "text"):
        rows: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
        for chunk in words(batch.column("text")):
            n = len(chunk.bounds) - 1
            data = chunk.data.tobytes()
            places: list[list[tuple[int, str]]] = [[] for _ in range(n)]
            last = {p[-1] for p, _ in phrases}
            for word in last:
                at = data.find(word)
                while at >= 0:
                    i = int(np.searchsorted(chunk.starts, at))
                    if i < len(chunk.starts) and chunk.starts[i] == at and chunk.ends[i] == at + len(word):
                        doc = int(np.searchsorted(chunk.bounds, i, "right")) - 1
                        for p, label in phrases:
                            lo = i - len(p) + 1
                            if p[-1] == word and lo >= chunk.bounds[doc] and all(data[chunk.starts[lo + j] : chunk.ends[lo + j]] == w for j, w in enumerate(p)):
                                places[doc].append((lo - int(chunk.bounds[doc]), label))
                    at = data.find(word, at + 1)
            size = np.diff(chunk.bounds)
            for doc in range(n):
                base = sorted(places[doc])
                labels = {x for _, x in base}
                score = 0.9 if base else 0.0
                more: set[str] = set()
                for _, _, rule in detections(data[chunk.offsets[doc] : chunk.offsets[doc + 1]].decode("utf-8", "replace")):
                    more.add(rule.label)
                    score = max(score, rule.confidence)
                values = (int(size[doc]), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)), ",".join(sorted(labels | more)), score)
                for k, v in zip(rows, values):
                    rows[k].append(v)
        types = (pa.int64(),) * 4 + (pa.string(),) * 2 + (pa.float64(),)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})


def scan(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each row of docs."""
    importable(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
