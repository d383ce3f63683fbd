"""License scans: ordered signature rules behind a keyword prefilter, with column functions only.

Every rule is a regular expression with keywords that its matches must contain. A text without any keyword is left at once; of
the others only the rules whose keywords occur are tried, group by group of their first one. Each match is a detection with an
interval. Of overlapping detections of different priority the higher one stays; of equal priority one inside another is suppressed
(of equal intervals the one whose label comes later). Beside the rules, the base phrases are found word by word.

Defined cases: a null text counts as empty; texts are scanned whole; repeated rows are scanned alike; an empty table gives no rows;
columns other than those named are ignored. A text's detections meet in one task, which one text bounds.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_id

# Word characters, and the class of all others (A-Z counts as a word character in any case).
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: phrase, label, words that a text needs for it
PHRASES = (("cc by", "cc-by", ("cc", "by")), ("general public license", "gpl", ("general", "public", "license")), ("all rights reserved", "reserved", ("all", "rights", "reserved")))


@dataclass(frozen=True)
class Rule:
    label: str
    #: lower-case strings that a text must hold for the rule to be tried
    keys: tuple[str, ...]
    pattern: str
    #: lower wins
    priority: int
    confidence: float


#: label, SPDX identifiers, name as a regular expression, keyword of the name (lower case; one for each alternative where they share none), page as a regular expression or ""
LICENSES = (
    ("apache-2.0", r"Apache-2\.0", r"Apache\s+(?:Software\s+)?Licen[cs]e,?\s*(?:\(?\s*(?:Version|v)?\.?\s*2(?:\.0)?\)?)", "apache", r"apache\.org/licenses/LICENSE-2\.0"),
    ("apache-1.1", r"Apache-1\.1", r"Apache\s+(?:Software\s+)?Licen[cs]e,?\s*(?:Version|v)?\.?\s*1\.1", "apache", r"apache\.org/licenses/LICENSE-1\.1"),
    ("apache-1.0", r"Apache-1\.0", r"Apache\s+(?:Software\s+)?Licen[cs]e,?\s*(?:Version|v)?\.?\s*1\.0", "apache", r"apache\.org/licenses/LICENSE-1\.0"),
    ("mit", r"MIT", r"(?:the\s+)?MIT\s+Licen[cs]e", "mit", r"opensource\.org/licen[cs]es?/mit"),
    ("mit-0", r"MIT-0", r"MIT\s+No\s+Attribution", "attribution", r"opensource\.org/licen[cs]es?/mit-0"),
    ("x11", r"X11", r"X11\s+Licen[cs]e", "x11", ""),
    ("isc", r"ISC", r"ISC\s+Licen[cs]e", "isc", r"opensource\.org/licen[cs]es?/isc"),
    ("bsd-2-clause", r"BSD-2-Clause", r"(?:Simplified|FreeBSD|(?:2|two)[- ]clause)\s+BSD\s+Licen[cs]e|BSD\s+(?:2|two)[- ]Clause", "bsd", r"opensource\.org/licen[cs]es?/bsd-2-clause"),
    ("bsd-3-clause", r"BSD-3-Clause", r"(?:New|Revised|Modified|(?:3|three)[- ]clause)\s+BSD\s+Licen[cs]e|BSD\s+(?:3|three)[- ]Clause", "bsd", r"opensource\.org/licen[cs]es?/bsd-3-clause"),
    ("bsd-4-clause", r"BSD-4-Clause", r"(?:Original|Old|(?:4|four)[- ]clause)\s+BSD\s+Licen[cs]e|BSD\s+(?:4|four)[- ]Clause", "bsd", ""),
    ("0bsd", r"0BSD", r"(?:Zero[- ]Clause|0[- ]Clause)\s+BSD", "bsd", r"opensource\.org/licen[cs]es?/0bsd"),
    ("gpl-1.0", r"GPL-1\.0(?:-only|-or-later|\+)?", r"GNU\s+General\s+Public\s+Licen[cs]e,?\s*(?:Version|v)\.?\s*1(?:\.0)?", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", r"GPL-2\.0(?:-only|-or-later|\+)?", r"GNU\s+General\s+Public\s+Licen[cs]e,?\s*(?:Version|v)\.?\s*2(?:\.0)?", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"GPL-3\.0(?:-only|-or-later|\+)?", r"GNU\s+General\s+Public\s+Licen[cs]e,?\s*(?:Version|v)\.?\s*3(?:\.0)?", "gnu", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.0", r"LGPL-2\.0(?:-only|-or-later|\+)?", r"GNU\s+Library\s+General\s+Public\s+Licen[cs]e", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0"),
    ("lgpl-2.1", r"LGPL-2\.1(?:-only|-or-later|\+)?", r"GNU\s+Lesser\s+General\s+Public\s+Licen[cs]e,?\s*(?:Version|v)\.?\s*2\.1", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"LGPL-3\.0(?:-only|-or-later|\+)?", r"GNU\s+Lesser\s+General\s+Public\s+Licen[cs]e,?\s*(?:Version|v)\.?\s*3(?:\.0)?", "gnu", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", r"AGPL-3\.0(?:-only|-or-later|\+)?", r"GNU\s+Affero\s+General\s+Public\s+Licen[cs]e", "affero", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.3", r"GFDL-1\.[123](?:-only|-or-later)?", r"GNU\s+Free\s+Documentation\s+Licen[cs]e", "gnu", r"gnu\.org/licenses/fdl"),
    ("mpl-1.1", r"MPL-1\.1", r"Mozilla\s+Public\s+Licen[cs]e,?\s*(?:Version|v)?\.?\s*1\.1", "mozilla", r"mozilla\.org/MPL/1\.1"),
    ("mpl-2.0", r"MPL-2\.0", r"Mozilla\s+Public\s+Licen[cs]e,?\s*(?:Version|v)?\.?\s*2(?:\.0)?", "mozilla", r"mozilla\.org/MPL/2\.0"),
    ("epl-1.0", r"EPL-1\.0", r"Eclipse\s+Public\s+Licen[cs]e\s*[-,]?\s*(?:Version|v)?\.?\s*1(?:\.0)?", "eclipse", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"EPL-2\.0", r"Eclipse\s+Public\s+Licen[cs]e\s*[-,]?\s*(?:Version|v)?\.?\s*2(?:\.0)?", "eclipse", r"eclipse\.org/legal/epl-(?:v|20)"),
    ("edl-1.0", r"EDL-1\.0", r"Eclipse\s+Distribution\s+Licen[cs]e", "eclipse", r"eclipse\.org/org/documents/edl"),
    ("cddl-1.0", r"CDDL-1\.0", r"Common\s+Development\s+and\s+Distribution\s+Licen[cs]e(?!.{0,12}1\.1)", "distribution", r"opensource\.org/licen[cs]es?/cddl"),
    ("cddl-1.1", r"CDDL-1\.1", r"Common\s+Development\s+and\s+Distribution\s+Licen[cs]e.{0,12}1\.1", "distribution", ""),
    ("cpl-1.0", r"CPL-1\.0", r"Common\s+Public\s+Licen[cs]e", "common", ""),
    ("ipl-1.0", r"IPL-1\.0", r"IBM\s+Public\s+Licen[cs]e", "ibm", ""),
    ("artistic-1.0", r"Artistic-1\.0(?:-Perl|-cl8)?", r"(?:the\s+)?Artistic\s+Licen[cs]e(?!,?\s*(?:Version|v)?\.?\s*2)", "artistic", ""),
    ("artistic-2.0", r"Artistic-2\.0", r"(?:the\s+)?Artistic\s+Licen[cs]e,?\s*(?:Version|v)?\.?\s*2(?:\.0)?", "artistic", r"opensource\.org/licen[cs]es?/artistic-2"),
    ("bsl-1.0", r"BSL-1\.0", r"Boost\s+Software\s+Licen[cs]e", "boost", r"boost\.org/LICENSE_1_0"),
    ("busl-1.1", r"BUSL-1\.1", r"Business\s+Source\s+Licen[cs]e", "business", r"mariadb\.com/bsl11"),
    ("unlicense", r"Unlicense", r"(?:the\s+)?Unlicen[cs]e\b", "unlicen", r"unlicense\.org"),
    ("wtfpl", r"WTFPL", r"Do\s+What\s+The\s+F\S+k\s+You\s+Want\s+To\s+Public\s+Licen[cs]e", "want", r"wtfpl\.net"),
    ("zlib", r"Zlib", r"zlib(?:/libpng)?\s+Licen[cs]e", "zlib", r"opensource\.org/licen[cs]es?/zlib"),
    ("libpng", r"Libpng|libpng-2\.0", r"libpng\s+Licen[cs]e", "libpng", ""),
    ("openssl", r"OpenSSL", r"OpenSSL\s+Licen[cs]e", "openssl", ""),
    ("ssleay", r"SSLeay", r"SSLeay\s+Licen[cs]e", "ssleay", ""),
    ("python-2.0", r"Python-2\.0|PSF-2\.0", r"Python\s+Software\s+Foundation\s+Licen[cs]e|PSF\s+Licen[cs]e", "licen", r"python\.org/psf/license"),
    ("php-3.01", r"PHP-3\.0(?:1)?", r"(?:the\s+)?PHP\s+Licen[cs]e", "php", r"php\.net/license"),
    ("ruby", r"Ruby", r"Ruby(?:'s)?\s+Licen[cs]e", "ruby", ""),
    ("postgresql", r"PostgreSQL", r"PostgreSQL\s+Licen[cs]e", "postgresql", r"postgresql\.org/about/licence"),
    ("ncsa", r"NCSA", r"University\s+of\s+Illinois(?:/NCSA)?\s+Open\s+Source\s+Licen[cs]e", "illinois", ""),
    ("w3c", r"W3C(?:-\d+)?", r"W3C\s+Software(?:\s+Notice)?(?:\s+and)?\s+Licen[cs]e", "w3c", r"w3\.org/Consortium/Legal"),
    ("afl-3.0", r"AFL-3\.0", r"Academic\s+Free\s+Licen[cs]e", "academic", ""),
    ("osl-3.0", r"OSL-3\.0", r"Open\s+Software\s+Licen[cs]e", "software", ""),
    ("ms-pl", r"MS-PL", r"Microsoft\s+Public\s+Licen[cs]e", "microsoft", r"microsoft\.com/.{0,40}ms-pl"),
    ("ms-rl", r"MS-RL", r"Microsoft\s+Reciprocal\s+Licen[cs]e", "microsoft", ""),
    ("eupl-1.2", r"EUPL-1\.[12]", r"European\s+Union\s+Public\s+Licen[cs]e", "european", r"joinup\.ec\.europa\.eu/.{0,60}eupl"),
    ("cecill-2.1", r"CECILL-2\.[01]", r"CeCILL\s+(?:Free\s+Software\s+)?Licen[cs]e", "cecill", r"cecill\.info"),
    ("ofl-1.1", r"OFL-1\.[01]", r"SIL\s+Open\s+Font\s+Licen[cs]e", "font", r"scripts\.sil\.org/OFL"),
    ("ubuntu-font-1.0", r"Ubuntu-font-1\.0", r"Ubuntu\s+Font\s+Licen[cs]e", "ubuntu", ""),
    ("lppl-1.3c", r"LPPL-1\.3[ac]?", r"LaTeX\s+Project\s+Public\s+Licen[cs]e", "latex", r"latex-project\.org/lppl"),
    ("qpl-1.0", r"QPL-1\.0", r"Q\s+Public\s+Licen[cs]e", "public", ""),
    ("sleepycat", r"Sleepycat", r"Sleepycat\s+Licen[cs]e", "sleepycat", ""),
    ("sspl-1.0", r"SSPL-1\.0", r"Server\s+Side\s+Public\s+Licen[cs]e", "server", ""),
    ("elastic-2.0", r"Elastic-2\.0", r"Elastic\s+Licen[cs]e", "elastic", r"elastic\.co/licensing"),
    ("json", r"JSON", r"shall\s+be\s+used\s+for\s+Good,\s+not\s+Evil", "evil", r"json\.org/license"),
    ("vim", r"Vim", r"Vim\s+Licen[cs]e", "vim", ""),
    ("curl", r"curl", r"curl\s+Licen[cs]e", "curl", ""),
    ("tcl", r"TCL", r"Tcl/Tk\s+Licen[cs]e", "tcl", ""),
    ("unicode-3.0", r"Unicode-3\.0|Unicode-DFS-2016", r"Unicode\s+Licen[cs]e", "unicode", r"unicode\.org/(?:license|copyright)"),
    ("hpnd", r"HPND", r"Historical\s+Permission\s+Notice", "historical", ""),
    ("odbl-1.0", r"ODbL-1\.0", r"Open\s+(?:Data\s+Commons\s+Open\s+)?Database\s+Licen[cs]e", "database", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", r"ODC-By-1\.0", r"Open\s+Data\s+Commons\s+Attribution", "commons", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", r"PDDL-1\.0", r"Public\s+Domain\s+Dedication\s+and\s+Licen[cs]e", "dedication", r"opendatacommons\.org/licenses/pddl"),
    ("cc0-1.0", r"CC0-1\.0", r"CC0(?:\s*1\.0)?|Creative\s+Commons\s+Zero", "cc0|zero", r"creativecommons\.org/publicdomain/zero"),
    ("cc-pdm-1.0", r"CC-PDM-1\.0", r"Public\s+Domain\s+Mark", "domain", r"creativecommons\.org/publicdomain/mark"),
    ("openrail", r"OpenRAIL(?:-M)?", r"(?:Open\s*)?RAIL(?:-M)?\s+Licen[cs]e", "rail", ""),
)

#: the Creative Commons suite: label stem, clauses as a regular expression
CC = (("cc-by", "BY"), ("cc-by-sa", "BY-SA"), ("cc-by-nd", "BY-ND"), ("cc-by-nc", "BY-NC"), ("cc-by-nc-sa", "BY-NC-SA"), ("cc-by-nc-nd", "BY-NC-ND"))
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: statements that name no license: label, keyword (a part of one word, as any space may be a line's end), pattern
NOTICES = (
    ("reserved", "reserved", r"All\s+rights\s+reserved"),
    ("copyright", "copyright", r"Copyright\s*(?:\(c\)|©)?\s*(?:19|20)\d\d"),
    ("copyright", "©", r"©\s*(?:19|20)\d\d"),
    ("public-domain", "domain", r"(?:in|into|to)\s+the\s+public\s+domain"),
    ("proprietary", "confidential", r"proprietary\s+and\s+confidential|confidential\s+and\s+proprietary"),
    ("proprietary", "copied", r"may\s+not\s+be\s+copied"),
    ("proprietary", "reproduced", r"may\s+not\s+be\s+reproduced"),
    ("proprietary", "distributed", r"may\s+not\s+be\s+distributed"),
    ("proprietary", "unauthori", r"unauthori[sz]ed\s+(?:copying|reproduction|distribution)"),
    ("proprietary", "secrets", r"trade\s+secrets\s+of"),
    ("proprietary", "exclusive", r"exclusive\s+property\s+of"),
    ("proprietary", "consent", r"without\s+(?:the\s+)?(?:prior\s+)?(?:express\s+)?written\s+consent"),
    ("permissive", "hereby", r"Permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge"),
    ("permissive", "redistribution", r"Redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without"),
    ("permissive", "sublicense", r"copy,\s+modify,\s+merge,\s+publish,\s+distribute,\s+sublicense"),
    ("permissive", "restriction", r"deal\s+in\s+the\s+Software\s+without\s+restriction"),
    ("permissive", "substantial", r"included\s+in\s+all\s+copies\s+or\s+substantial\s+portions\s+of\s+the\s+Software"),
    ("permissive", "distribute", r"copy,\s+modify,?\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee"),
    ("permissive", "retain", r"must\s+retain\s+the\s+above\s+copyright\s+notice,\s+this\s+list\s+of\s+conditions"),
    ("permissive", "reproduce", r"must\s+reproduce\s+the\s+above\s+copyright\s+notice"),
    ("permissive", "endorse", r"used\s+to\s+endorse\s+or\s+promote\s+products\s+derived\s+from\s+this\s+software"),
    ("permissive", "acknowledg", r"must\s+display\s+the\s+following\s+acknowledge?ment"),
    ("permissive", "misrepresented", r"origin\s+of\s+this\s+software\s+must\s+not\s+be\s+misrepresented"),
    ("permissive", "altered", r"Altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked"),
    ("copyleft", "redistribute", r"you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it"),
    ("copyleft", "licen", r"of\s+the\s+Licen[cs]e,\s+or\s+\(at\s+your\s+option\)\s+any\s+later\s+version"),
    ("copyleft", "gnu", r"should\s+have\s+received\s+a\s+copy\s+of\s+the\s+GNU"),
    ("copyleft", "corresponding", r"complete\s+corresponding\s+(?:machine-readable\s+)?source\s+code"),
    ("copyleft", "subject", r"Source\s+Code\s+Form\s+is\s+subject\s+to\s+the\s+terms"),
    ("non-commercial", "commercial", r"for\s+(?:personal,\s+)?non-?commercial\s+(?:use|purposes)\s+only"),
    ("no-derivatives", "derivative", r"no\s+derivative\s+works\s+(?:are\s+)?(?:permitted|allowed)"),
    ("patent", "patent", r"(?:royalty-free|irrevocable)\s+patent\s+licen[cs]e"),
    ("trademark", "trademark", r"registered\s+trademarks?\s+of"),
    ("eula", "licen", r"End[- ]User\s+Licen[cs]e\s+Agreement"),
    ("dual-licensed", "licen", r"dual[- ]licen[cs]ed"),
    ("public-domain", "waive", r"waives\s+all\s+(?:copyright|of\s+(?:his|her|their)\s+rights)"),
    ("warranty", "warrant", r"without\s+warrant(?:y|ies)\s+of\s+any\s+kind|WITHOUT\s+ANY\s+WARRANTY"),
    ("warranty", "merchantability", r"warrant(?:y|ies)\s+of\s+merchantability"),
    ("warranty", "provided", r"SOFTWARE\s+IS\s+PROVIDED\s+.AS\s+IS"),
    ("warranty", "basis", r"on\s+an\s+.AS\s+IS.\s+BASIS"),
    ("warranty", "liable", r"in\s+no\s+event\s+shall\s+the\s+(?:authors?|copyright\s+holders?|regents)[^.;]{0,80}\s+be\s+liable"),
    ("gpl", "gnu", r"GNU\s+General\s+Public\s+Licen[cs]e"),
    ("lgpl", "lesser", r"GNU\s+Lesser\s+General\s+Public\s+Licen[cs]e"),
    ("bsd", "bsd", r"BSD[- ]\s*(?:style\s+)?Licen[cs]e"),
    ("cc", "commons", r"Creative\s+Commons(?:\s+Attribution)?"),
    ("terms", "terms", r"terms\s+of\s+(?:service|use)"),
)


def keys_of(keyword: str, pattern: str) -> tuple[str, ...]:
    """The keyword, and the word license where every alternative of the pattern holds it."""
    return (keyword, "licen") if keyword != "licen" and all("icen" in x for x in pattern.split("|")) else (keyword,)


def rules() -> list[Rule]:
    """Identifiers before pages, pages before grants, grants before names, names before notices."""
    out = []
    edge, stop = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
    grant = r"(?:licen[cs]ed|released|distributed|available|provided|published)\s+under\s+(?:the\s+|a\s+)?(?:terms\s+of\s+(?:the\s+)?)?"
    for label, spdx, name, keyword, page in LICENSES:
        out.append(Rule(label, ("spdx", "licen"), rf"(?i)SPDX-License-Identifier:\s*\(?(?:{spdx})(?![A-Za-z0-9.-])", 0, 1.0))
        if page:
            out.append(Rule(label, keys_of(page.split(r"\.")[0], page.lower()), rf"(?i){page}", 1, 0.95))
        for key, part in zip(keyword.split("|"), name.split("|"), strict=True) if "|" in keyword else [(keyword, name)]:
            keys = keys_of(key, part)
            out.append(Rule(label, (*keys, "under"), rf"(?i){grant}(?:{part}){stop}", 2, 0.9))
            out.append(Rule(label, keys, rf"(?i){edge}(?:{part}){stop}", 3, 0.7))
    for stem, clauses in CC:
        spaced = clauses.replace("-", "[- ]")
        for version in CC_VERSIONS:
            v, label = version.replace(".", r"\."), f"{stem}-{version}"
            out.append(Rule(label, ("spdx", "licen"), rf"(?i)SPDX-License-Identifier:\s*CC-{clauses}-{v}", 0, 1.0))
            out.append(Rule(label, ("creativecommons", "licen"), rf"(?i)creativecommons\.org/licenses/{clauses}/{v}", 1, 0.95))
            for sep in " -":
                out.append(Rule(label, (f"cc{sep}by", version, "under"), rf"(?i){grant}CC{sep}{spaced}[- ]{v}{stop}", 2, 0.9))
                out.append(Rule(label, (f"cc{sep}by", version), rf"(?i){edge}CC{sep}{spaced}[- ]{v}{stop}", 3, 0.8))
        out += [Rule(stem, (f"cc{sep}by",), rf"(?i){edge}CC{sep}{spaced}{stop}", 4, 0.6) for sep in " -"]
    out += [Rule(label, (keyword,), rf"(?i){edge}(?:{pattern}){stop}", 5, 0.4) for label, keyword, pattern in NOTICES]
    return out


def phrase_pattern(phrase: str) -> str:
    return rf"(?i)(?<!{WORD})" + f"{GAP}+".join(phrase.split()) + rf"(?!{WORD})"


def once(value: Column, then) -> Column:
    """then(value) with value computed once, however often then uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+")).cast("long")


def places(text: Column, low: Column, n_words: Column) -> Column:
    """For each phrase (n, first, last): how often it stands in text, and its first and last word number."""

    def of(phrase: str, needs: tuple[str, ...]) -> Column:
        possible = F.lit(True)
        for w in needs:
            possible = possible & F.contains(low, F.lit(w))
        found = once(F.split(text, phrase_pattern(phrase), -1), lambda p: F.when(F.size(p) > 1, F.struct((F.size(p) - 1).cast("long").alias("n"), words_in(F.element_at(p, 1)).alias("first"), (n_words - len(phrase.split()) - words_in(F.element_at(p, -1))).alias("last"))))
        return F.when(possible, found)

    return F.array(*[of(p, needs) for p, _, needs in PHRASES])


DETECTIONS = "array<struct<rule:int,pos:int,gap:int,n:int,label:string,priority:int,confidence:double>>"


def detections(text: Column, low: Column, given: list[Rule]) -> Column:
    """array of (rule, pos, gap, n, label, priority, confidence): all matches of the rules whose keys low contains; gap: characters since the match before."""
    groups: dict[str, list[dict]] = {}
    for i, r in enumerate(given):
        groups.setdefault(r.keys[0], []).append(asdict(r) | {"rule": i, "keys": r.keys[1:]})
    # one constant that is parsed while planning, instead of thousands of literals for the optimiser to walk through
    kind = "array<struct<key:string,rules:array<struct<rule:int,label:string,keys:array<string>,pattern:string,priority:int,confidence:double>>>>"
    table = F.from_json(F.lit(json.dumps([{"key": k, "rules": r} for k, r in groups.items()])), kind)

    def of(rule: Column) -> Column:
        found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
        lengths = F.transform(found, F.length)
        # without a match nothing is split
        gaps = F.when(F.size(found) > 0, F.transform(F.split(text, rule["pattern"], -1), F.length))
        spans = F.filter(F.zip_with(gaps, lengths, lambda g, n: F.struct(g.alias("gap"), n.alias("n"))), lambda x: x["n"].isNotNull())
        named = lambda x, i: F.struct(rule["rule"].alias("rule"), i.alias("pos"), x["gap"].alias("gap"), x["n"].alias("n"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence"))
        return F.coalesce(F.transform(spans, named), F.array().cast(DETECTIONS))

    tried = F.filter(F.flatten(F.transform(F.filter(table, lambda g: F.contains(low, g["key"])), lambda g: g["rules"])), lambda r: F.forall(r["keys"], lambda k: F.contains(low, k)))
    return F.flatten(F.transform(tried, of))


def spans(docs: DataFrame, keep: list[str], text: str = "text", given: list[Rule] | None = None) -> DataFrame:
    """keep, __rid, n_words, phrases and one row for each detection (start is null where there is none), hidden where a kept one suppresses it."""
    given = given or rules()
    needed = {"licen" if "licen" in r.keys else r.keys[0] for r in given}
    # a string that holds another one needs no test of its own
    gates = sorted(k for k in needed if not any(o != k and o in k for o in needed))
    read = docs.select(*keep, row_id().alias("__rid"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # columns of their own, so that the tests below are compiled and the text is lowered and split once
    whole, low = F.col("__text"), F.col("__low")
    counted = read.withColumn("__low", F.lower("__text")).withColumn("n_words", F.size(F.array_remove(F.split("__text", f"{GAP}+", -1), "")).cast("long"))
    any_gate = F.lit(False)
    for g in gates:
        any_gate = any_gate | F.contains(low, F.lit(g))
    looked = counted.select(*keep, "__rid", "n_words", places(whole, low, F.col("n_words")).alias("phrases"), F.when(any_gate, detections(whole, low, given)).cast(DETECTIONS).alias("found"))
    rows = looked.select(*keep, "__rid", "n_words", "phrases", F.explode_outer("found").alias("d")).select(*keep, "__rid", "n_words", "phrases", "d.*")
    # one exchange serves all windows
    rows = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__rid")
    so_far = Window.partitionBy("__rid", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far)).withColumn("start", F.col("end") - F.col("n")).drop("rule", "pos", "gap", "n")
    return told_hidden(rows, sorted({r.priority for r in given}))


def told_hidden(rows: DataFrame, priorities: list[int]) -> DataFrame:
    """rows with hidden: whether a detection overlaps a kept one of a higher priority, or lies within a kept one of its own.

    The priorities are settled one after another, so that what is hidden hides nothing.
    """
    order = "start", F.desc("end"), "priority", "label"
    reverse = F.desc("start"), "end", F.desc("priority"), F.desc("label")
    earlier, later = (Window.partitionBy("__rid").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1) for by in (order, reverse))
    live, no = F.col("__live"), F.lit(False)
    rows = rows.withColumn("__live", no)
    for k, p in enumerate(priorities):
        free = F.coalesce(F.col("priority") == p, no)
        if k:
            reached = (F.max(F.when(live, F.col("end"))).over(earlier) > F.col("start")) | (F.min(F.when(live, F.col("start"))).over(later) < F.col("end"))
            free = free & ~F.coalesce(reached, no)
        rows = rows.withColumn("__free", free)
        within = F.max(F.when(F.col("__free"), F.col("end"))).over(earlier) >= F.col("end")
        rows = rows.withColumn("__live", live | (F.col("__free") & ~F.coalesce(within, no)))
    return rows.withColumn("hidden", ~live).drop("__live", "__free")


def scan(docs: DataFrame, keep: list[str], text: str = "text", given: list[Rule] | None = None) -> DataFrame:
    """The columns of ``keep`` with phrase places, labels and a score, one row for each row of docs."""
    live = ~F.col("hidden")
    grouped = spans(docs, keep, text, given).groupBy("__rid").agg(
        *[F.first(c).alias(c) for c in [*keep, "n_words", "phrases"]],
        F.collect_set(F.when(live, F.col("label"))).alias("found"),
        F.coalesce(F.max(F.when(live, F.col("confidence"))), F.lit(0.0)).alias("sure"),
    )
    held = F.filter("phrases", lambda p: p.isNotNull())
    base = F.array_compact(F.array(*[F.when(F.element_at("phrases", k + 1).isNotNull(), F.lit(label)) for k, (_, label, _) in enumerate(PHRASES)]))
    return grouped.select(
        *keep,
        "n_words",
        F.aggregate(held, F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n_base"),
        F.array_min(F.transform(held, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(held, lambda p: p["last"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "found")), ",").alias("labels"),
        F.greatest("sure", F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
