"""Page boilerplate against main content (problem 4): two passes of block rules over the lines of a text.

Pass one decides each line by itself from its length, its stop-word density and its link density (separators, list
marks, bracketed buttons). Cues of consent, offers, sharing, credits and legal notices, addresses to the reader and
publisher names are further evidence: a sentence is a notice if the page speaks of itself in it (by a name or an
address) and a notice of some kind is given, or name and address meet, never for one of these alone.
Pass two gives short, undecided lines the label of the nearest decided neighbours.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswerk.session import read_table

STORY, PAGE, SHORT, BLANK, HEADLINE, SUBHEAD = 1, 0, 2, 3, 4, 5

#: A sentence of at least so many words is decided by itself; shorter ones look at their neighbours.
LONG_WORDS = 6
#: Running text of the six languages has over a fifth of stop words; names and menus have fewer.
MIN_STOP_DENSITY = 0.12
#: Separators for each word from which a line counts as links.
LINK_DENSITY = 0.34

# Frequent function words of English, French, German, Spanish, Italian and Portuguese.
STOP_WORDS = frozenset(
    "the of and to in a an that for on with at by from is was were be been it he she they who would not as this after about than his her its which had has have will said or but while when"
    " le la les un une des du de et à au aux en dans pour sur par avec que qui ne pas est a ont été ce cette se son sa ses plus il elle après tandis selon dont lors d l qu n s"
    " der die das den dem des ein eine einen einem einer und in im am zu zum zur von vom mit auf für ist war nicht sich als auch nach bei aus hat haben es sie er wegen über rund bis noch schon seit"
    " el los las una unos del al y o que en por para con no se su sus es fue ha han más desde tras sin según mientras hasta ante unas lo"
    " il lo gli i uno di del della dei delle dello al alla allo ai nel nella da dal per tra fra con non si è ha hanno che dopo secondo mentre sul sulla alle"
    " o os as um uma do da dos das no na nos nas ao à em de por pelo pela para com não se foi que mais sem sob entre após segundo enquanto desde".split()
)

# Cues by which a page speaks of itself, in six languages. None of them decides a sentence alone.
_CUES = {
    "address": "we|our|your|you|us|this site|this page|nous|votre|vos|vous|ce site|cette page|wir|unsere|unseren|unserer|ihre|ihrem|ihren|ihrer|ihres|ihr|sie|diese seite|nosotros|nuestro|nuestros|nuestra|nuestras|tu|tus|te|este sitio|esta página|noi|nostro|nostri|nostra|nostre|tuo|tua|tue|accetti|questo sito|questa pagina|nós|nosso|nossos|nossa|nossas|seu aparelho|sua|suas|este sítio|aceita",
    "consent": "cookie|cookies|traceurs|small files|petits fichiers|kleine dateien|pequeños archivos|piccoli file|pequenos ficheiros|privacy|vie privée|privatsphäre|privacidad|privacidade|riservatezza",
    "legal": "copyright|all rights reserved|tous droits réservés|alle rechte vorbehalten|todos los derechos|tutti i diritti|todos os direitos|all content|the content of|tous les contenus|alle inhalte|todos los contenidos|tutti i contenuti|todos os conteúdos|external sites|fremde seiten|sitios externos|siti esterni|sítios externos|"
    "reproduction of this|toute reproduction|riproduzione anche|reprodução total|reproducción total|is not responsible|non responsable|haftet nicht|no responde|non risponde|não responde|views expressed|opinions exprimées|geäusserten meinungen|opiniones expresadas|opinioni espresse|opiniões expressas|registered under|registre no|case file|media ltd|médias sa",
    "terms": "reproduction|reproducción|riproduzione|reprodução|licence|license|lizenz|licencia|licenza|licença|handelsregister|aktenzeichen|expediente|processo",
    "offer": "newsletter|sign up|subscribe|abonnez|abonnieren|suscríbete|abbonati|assine|briefing|inbox|lettre du matin|lettera del mattino|carta de la mañana|morgenbrief|alert|alerts|alerte|alertes|eilmeldungen|benachrichtigungen|alertas|avisos|notificaciones|avvisi|notifiche|notificações|reader of|lecteur de|leser von|lector de|lettore di|lê|"
    "support our|soutenez|unterstützen sie|apoya|sostieni|apoie|a month|par mois|im monat|al mes|al mese|por mês|get the|recevez|erhalten sie|recibe|ricevi|receba",
    "share": "tap|share|send|partagez|envoyez|teilen|senden|schicken|comparte|envía|enviar|condividi|invia|partilhe|envie|by mail|par mail|per mail|por correo|via mail|por mail",
    "credit": "newsroom|staff|agencies|agences|agenturen|agencias|agenzie|agências|rédaction|redaktion|redacción|redazione|redação|correspondents|correspondants|korrespondenten|corresponsales|corrispondenti|correspondentes|night desk|edición nocturna|turno di notte|edição da noite",
    "reference": "see more|read also|read more|see also|à lire aussi|lire aussi|voir aussi|voir plus|lesen sie auch|mehr dazu|mehr|siehe auch|lea también|lee también|ver más|leggi anche|vedi anche|altro|leia também|leia ainda|ver mais",
}
_BY_FIRST: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
for _kind, _phrases in _CUES.items():
    for _phrase in _phrases.split("|"):
        _BY_FIRST.setdefault(_phrase.split()[0], []).append((_kind, tuple(_phrase.split())))
_QUOTED = re.compile(r"[“„«][^“”„«»]*[”“»]|\"[^\"]*\"")
_ADVERT = frozenset("advertisement advert anzeige annonce anuncio annuncio anúncio publicidad publicité".split())
_PROMPT = re.compile(r"^[^.]{3,60}\?\s+[^?]{3,40}!$|!$")
_ENDING = re.compile(r"[.!?…][\"'”»“’)\]]*(?:\s\([^()]*\))?$")
_SENTENCE_INSIDE = re.compile(r"[.!?…][\"'”»“]?\s+[\"'“„«¡¿(]*\s?\w")
_LIST_MARK = re.compile(r"^(?:[•*·▪–—-]|\d{1,3}[.)])\s+")
_SUBHEAD = re.compile(r"^[^\W\d_][^:.!?|/>»·]{2,48}?\s?:\s?[^\W\d_][\w’'-]*$")
_RESULT = re.compile(r"^.{2,60}\s[–—-]\s.{2,60}\s\d+\s?[:–-]\s?\d+$")
_BUTTONS = re.compile(r"\[[^\]]{1,24}\]|\([^)]{1,24}\)$")
_SEPARATOR = re.compile(r"\s[|/>·»–-]\s|\s{2,}|\s[|/>·»]|\|")
_WORD = re.compile(r"[^\W_]+")


class PublisherNames:
    """Finds publisher names in a line by their first word, so the number of names does not matter."""

    def __init__(self, names: list[str]):
        self.by_first: dict[str, list[tuple[str, ...]]] = {}
        for name in names:
            words = tuple(_WORD.findall(name.casefold()))
            if len(words) > 1:
                self.by_first.setdefault(words[0], []).append(words)
        self.firsts = frozenset(self.by_first)

    def longest(self, words: list[str]) -> int:
        """Words of the longest name that the line holds."""
        best = 0
        for i, word in enumerate(words):
            for name in self.by_first.get(word, ()):
                if len(name) > best and tuple(words[i : i + len(name)]) == name:
                    best = len(name)
        return best


#: Kinds by which a page speaks of itself, and kinds that need no such sign in a line that is no sentence.
_SELF, _ALONE = frozenset({"name", "address"}), frozenset({"legal", "consent", "reference"})


def cues(low: str, words: list[str], named: bool) -> set[str]:
    """The kinds of cues that the case-folded line holds: a publisher's name, an address to the reader, notices."""
    if '"' in low or "“" in low or "„" in low or "«" in low:
        low = _QUOTED.sub(" ", low)  # what somebody says is no notice of the page
        words = _WORD.findall(low)
    found = {"name"} if named else set()
    if "©" in low or low.startswith("(c)"):
        found.add("legal")
    if ">>" in low:
        found.add("reference")
    for i, word in enumerate(words):
        for kind, phrase in _BY_FIRST.get(word, ()):
            if (i == 0 or kind != "reference") and (len(phrase) == 1 or tuple(words[i : i + len(phrase)]) == phrase):
                found.add(kind)
    return found


def is_notice(found: set[str]) -> bool:
    """Whether the page speaks of itself and gives a notice of some kind, or speaks to its reader by its name."""
    return not found.isdisjoint(_SELF) and len(found) > 1


def decide(line: str, names: PublisherNames) -> int:
    """Pass one: STORY, PAGE, SHORT, HEADLINE or SUBHEAD for one line, BLANK for one without text.

    Running text of some length and stop-word density is story unless the page speaks of itself in it and gives a
    notice; lines of links are page; for the rest, lines without an end, a plain notice or a name that makes up the
    line is enough.
    """
    text = line.strip()
    if not text:
        return BLANK
    low = text.casefold()
    words = _WORD.findall(low)
    if not words:
        return PAGE
    name = 0 if names.firsts.isdisjoint(words) else names.longest(words)
    ended = _ENDING.search(text) is not None
    if ended:
        if len(words) < 14 and _PROMPT.search(text):
            return PAGE
        if len(words) < LONG_WORDS and not name:
            return SHORT
        if is_notice(cues(low, words, name > 0)):
            return PAGE
        return STORY if len(words) >= 12 or (len(words) >= LONG_WORDS and sum(w in STOP_WORDS for w in words) / len(words) >= MIN_STOP_DENSITY) else SHORT
    marked = _LIST_MARK.match(text)
    if _RESULT.match(text[marked.end() :] if marked else text):
        return STORY
    links = len(_SEPARATOR.findall(text)) + len(_BUTTONS.findall(text))
    if links and (links + 1) / len(words) >= LINK_DENSITY:
        return PAGE
    cut = _SENTENCE_INSIDE.search(text[marked.end() :] if marked else text) is not None  # running text that was cut off
    found = cues(low, words, name > 0)
    if is_notice(found) or (not cut and (not found.isdisjoint(_ALONE) or 3 * name >= len(words))):
        return PAGE
    if cut:
        return STORY
    if len(words) <= 9 and _SUBHEAD.match(text):
        return SUBHEAD
    # Headlines, menu items and labels end without a full stop; so does a sentence that was cut off.
    sentence = len(words) >= 4 and not marked and not links and _ADVERT.isdisjoint(words) and sum(w in STOP_WORDS for w in words) / len(words) >= 0.2
    return HEADLINE if sentence else PAGE


def label_lines(lines: list[str], names: PublisherNames) -> list[int]:
    """Both passes: STORY, PAGE or BLANK for each line of a text.

    A line that could be a headline or a sentence without its end is story only as a single line between story lines
    or behind the last of them; several such lines make a list of headlines. Subheadings are story unless the page
    surrounds them, other short lines follow their nearest decided neighbours.
    """
    labels = [decide(x, names) for x in lines]
    solid = [i for i, x in enumerate(labels) if x != BLANK]
    first_pass = [labels[i] for i in solid]
    known = [k for k, x in enumerate(first_pass) if x in (STORY, PAGE)]
    out = list(first_pass)
    for k, x in enumerate(first_pass):
        if x in (STORY, PAGE):
            continue
        before = first_pass[k - 1] if k else None
        after = first_pass[k + 1] if k + 1 < len(first_pass) else None
        if x == HEADLINE:
            whole = after is None or len(_WORD.findall(lines[solid[k]])) >= 6
            out[k] = STORY if whole and before in (STORY, SUBHEAD) and after in (STORY, SUBHEAD, None) else PAGE
            continue
        left = next((first_pass[j] for j in range(k - 1, -1, -1) if first_pass[j] in (STORY, PAGE)), None)
        right = next((first_pass[j] for j in range(k + 1, len(first_pass)) if first_pass[j] in (STORY, PAGE)), None)
        if x == SUBHEAD:
            out[k] = PAGE if known and left != STORY and right != STORY else STORY
        else:
            out[k] = left if right is None and left is not None else right if left is None and right is not None else left if left == right and left is not None else STORY
    for i, x in zip(solid, out, strict=True):
        labels[i] = x
    return labels


def has_text(content: str | None) -> bool:
    return content is not None and content.strip().casefold() not in ("", "none", "nan")


#: A register of more publishers than this would not fit every worker.
MAX_NAMES = 1_000_000


def publisher_names(sources: DataFrame) -> list[str]:
    """The publishers' display names; the sources table is the publishers' register, not a table of documents."""
    names = [r[0] for r in sources.select("display_name").where("display_name is not null").distinct().limit(MAX_NAMES + 1).collect()]
    if len(names) > MAX_NAMES:
        raise ValueError(f"the register has more than {MAX_NAMES} names")
    return sorted(names)


def _label_batches(names: list[str]):
    def run(batches):
        finder = PublisherNames(names)
        for batch in batches:
            ids, numbers = batch.column(0), []
            for content in batch.column(1).to_pylist():
                numbers.append([i for i, x in enumerate(label_lines(content.split("\n"), finder)) if x == PAGE] if has_text(content) else [])
            yield pa.RecordBatch.from_arrays([ids, pa.array(numbers, pa.list_(pa.int32()))], names=["id", "line_nos"])

    return run


def find_page_lines(df: DataFrame, sources: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """Rows (id, line_no): the non-blank lines that belong to the page and not to the story.

    Null, empty and None / nan texts and null ids give no rows; repeated rows of an id count once; extra columns are
    ignored; an empty table gives an empty result. Texts are read whole, however long.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("content"))
    labelled = rows.mapInArrow(_label_batches(publisher_names(sources)), "id string, line_nos array<int>").where(F.size("line_nos") > 0)
    return labelled.dropDuplicates(["id"]).select("id", F.explode("line_nos").alias("line_no"))


def main_content(df: DataFrame, sources: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """`df` with only the story lines left in `text_col`."""
    from presswerk.llm.repeated_lines import remove_lines

    return remove_lines(df, find_page_lines(df, sources, id_col, text_col), id_col, text_col)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_page_lines(read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources"))
