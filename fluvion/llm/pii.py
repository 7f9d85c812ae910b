"""Personal information in free text: spans found, scored, and replaced by typed placeholders.

Patterns propose spans; check digits (mod 97, mod 11, Luhn with a date, ...) confirm them, the words around a span move its
score; spans that reach the threshold stay, and of overlapping ones the stronger type. Names are judged by form and
context, and by which words the corpus itself uses as given names. Whole texts are worked on, in Arrow batches.
"""

from __future__ import annotations

import bisect
import functools
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.session import materialize

TYPES = ("email", "id_number", "phone", "address", "name")
THRESHOLD = 1.0

# Common given names of several languages, without accents: a hint among others, not a condition.
GIVEN = frozenset(
    """adam agnes ahmed aisha alan albert alejandro alex alexander ali alice amina ana anders andre andrea andrei andrew angela anita
    ann anna anne anton antonio arjun astrid barbara beatriz ben bernd birgit boris bruno camille carla carlos carmen caroline chen
    chloe christian christine clara claire claudia daniel david diana diego dora eduardo elena elisabeth elena emil emilia emma
    eric erik ernst eva fatima felix fernando francisco frank franz friedrich gabriel george gerhard giulia greta gustavo hans
    hannah heinrich helen helena helga henri henry hugo ibrahim igor imre inge ingrid inigo irina isabel ivan jack jacques james
    jan jane jean jens joana joao johan johanna john jonas jorge jose joseph juan judit julia jurgen karin karl katarina kevin
    klaus kofi laura leila leilani lena leon linda lisa louis lucas lucia luis luisa marc marcus maria marie mario marta martin
    mary mateo mehmet melanie michael miguel miriam mohamed monika nadia natalia nina noor olga omar oscar osei pablo patricia
    paul paulo pedro peter petra pierre rafael renata robert rosa samuel sandra sanjit sara simon sofia soren stefan sven
    tariq teresa thomas tomas victor wei yara yusuf zoe zuri""".split()
)

# Words that make a capitalised sequence the name of a body, a thing or a place.
NOT_PERSON = frozenset(
    """authority board bureau circle survey secretariat institute office desk watch society university agency centre center
    department ministry council company service services commission laboratory lab station gauge weir bridge dam river storm boat
    ship vessel road street lane avenue drive court close row way hill mill ferry ford bank upper lower north south east west old new
    turbid waters water silt basin delta load upland field notes sensor bottle spectrum rating catchment turbidity discharge
    position observer observateur observador beobachter unknown inconnu unbekannt desconocido desconhecido re sed src signed
    the a an in on at of for and with note suspended depth bed loads ice flow neighbouring merged satellite library inventory see
    contact dear kind regards la le les el los las der die das o os um une un une der dem den nach dank einzugsgebiet expediente
    mr mrs ms miss dr prof sir madam mme mlle herr frau don dona sr sra senor senora monsieur madame
    text call questions data form payment according we our new old card please this that he she it they storm winch until was is
    creek brook stream lake valley falls bay mountain canyon island forest harbour harbor pond marsh spring delta reservoir watershed
    ableser ableserin reader lecteur lectrice lector lectora leitor leitora observadora observatrice beobachterin
    head chief deputy team group committee trust fund limited ltd inc gmbh sarl project programme program archive museum library school
    qc nothing else january february march april may june july august september october november december monday tuesday
    wednesday thursday friday saturday sunday enero febrero marzo mayo junio julio agosto janvier fevrier mars avril mai juin juillet aout
    januar februar marz juni juli dezember oktober bureau rivers international national public house hydrology ssn cpf dni nif id passport""".split()
)

_UP = r"\p{Lu}"
_REST = r"[\p{L}\p{M}¡-¿’'ʼ]"
_PARTICLE = r"(?:(?:d[aeio]s?|del|della|di|van|von|vom|zu|zur|der|den|de la|de los|van der|van den|von der|bin|ibn|al|el|ben|le|la|du|des|ter|ten|af|av|y|e)\s+|(?:d|al|el|o)['’-])"
_WORD = rf"(?:[OD]['’])?{_UP}{_REST}+(?:-{_UP}{_REST}+)*"
_INITIAL = rf"{_UP}\.(?:-?{_UP}\.)*"
_GIVEN = rf"{_UP}{_REST}+(?:-{_UP}{_REST}+)*"

#: Name as written: given (or initials), middle initials or names, particle, surname; or surname, given.
_FORWARD = re.compile(rf"(?<![\p{{L}}\p{{N}}@._-])(?P<g>{_GIVEN}|{_INITIAL})(?P<m>(?:\s+{_INITIAL})*)\s+(?P<p>(?i:{_PARTICLE})*)(?P<s>{_WORD})(?![\p{{L}}\p{{N}}@_+]|[.-][\p{{L}}\p{{N}}])")
_BACKWARD = re.compile(rf"(?<![\p{{L}}\p{{N}}@._-])(?P<p>(?:{_PARTICLE})*)(?P<s>{_WORD}),\s+(?P<g>{_GIVEN}|{_INITIAL})(?P<m>(?:\s+{_INITIAL})*)(?![\p{{L}}\p{{N}}@_+]|[.-][\p{{L}}\p{{N}}])")
_SURNAME = re.compile(rf"(?<![\p{{L}}\p{{N}}])(?P<s>(?i:{_PARTICLE})*{_WORD})(?![\p{{L}}@])")

_TITLE = r"(?:(?<![\d][ ]?)M|(?i:mr|mrs|ms|miss|mx|dr|prof|professor|eng|mme|mlle|madame|monsieur|herr|frau|hr|fr|don|doña|dona|sr|sra|srta|señora?|senhora?|seu|dipl\.-ing|ing))"
_TITLED = re.compile(rf"(?<![\p{{L}}\p{{N}}@._-]){_TITLE}\.?\s+(?:(?!M\.?\s){_TITLE}\.?\s+)?(?=(?:(?:d|al|el|o)['’-])?[\p{{Lu}}]|(?i:{_PARTICLE})[\p{{Lu}}])")

# Contexts that announce a person right after them; such patterns end where the span begins, so they are matched backwards from there.
_ANNOUNCED = (
    r"""(?:(?<![\p{L}\p{N}])(?:
      observer|observateur|observatrice|observador|observadora|beobachter|beobachterin|observed\ by|signed|sign[ée]|firmado|assinado|gez|unterzeichnet|gezeichnet
      |contact|contato|contacto|kontakt|ansprechpartner(?:in)?(?:\ ist)?|name|nom|nombre|nome|dear|hello|hi|hallo|liebe[r]?|sehr\ geehrte[r]?|cher|ch[èe]re|estimad[oa]|prezad[oa]|car[oa]
      |according\ to|selon|d['’]apr[èe]s|laut|seg[úu]n|segundo|gem[äa][ßs]+
      |(?:was|is|been|were)\ read\ by|read\ by|written\ by|taken\ by|filled\ in\ by|measured\ by|sampled\ by|collected\ by|lu\ par|rempli\ par|le[íi]do\ por|abgelesen\ von|ausgef[üu]llt\ von|preenchido\ por|rellenado\ por
      |sampled\ together\ with|together\ with|avec|zusammen\ mit|junto\ con|junto\ a|juntamente\ com
      |we\ thank|thanks\ to|thank\ you|merci\ [àa]|gracias\ a|agradecemos\ a|obrigado\ a|dank\ an|danke
      |boat\ driver|driver|the\ reader|reader\ at\ this\ site,?|le\ lecteur,?|la\ lectrice,?|el\ lector,?|la\ lectora,?|o\ leitor,?|a\ leitora,?|der\ ableser|die\ ableserin
      |(?:to|of|by)\ the\ observer|new\ observer[^.]{0,40}?\bis|on\ is|text\ of|letter\ of|mail\ of|notes\ of|report\ of|questions\ to
      |vers[ée]e?\ [àa]|pay[ée]e?\ [àa]|autorizado\ a|autorizada\ a|autorizado\ para|pago\ a|verg[üu]tung\ an|zahlung\ an|pagamento\ (?:autorizado\ )?a|paid\ to
      |while|and|et|und|y|e|mientras|pendant\ que
    )\s*[:：]?\s*|[：]\s*|(?:观测员|联系人|姓名|签名|发给|付给|感谢|谢谢|寄给|致|据|由|给)\s*[:：]?\s*)"""
)
_BEFORE = re.compile(f"(?ixr){_ANNOUNCED}$")
_WEAK = re.compile(r"(?ir)(?:\b(?:while|and|et|und|y|e|mientras|contact|kontakt|dear|signed|reader|name|avec|dank an|merci [àa]|agradecemos a|we thank|thanks to|on is|according to|selon|laut|seg[úu]n|segundo)\s*[:：]?\s*)$")
# Contexts that follow a person.
_AFTER = re.compile(
    r"""(?ix)\s*,?\s*(?:
      (?:waded|held|called|took\ over|disagrees?|keeps?|doubts?|lives?|said|says|wrote|reports?|reported|noticed|measured|read|reads|thinks|was\ here|hat|wohnt|sagt|meldet|rief|habite|garde|signale|a\ appel[ée]|vive|guarda|dice|avisa|mora|disse|avisa|llam[óo])\b
      |for\ (?:the|his|her)\ notes|until\ the\ pen|,?\ she\ can|,?\ he\ can|reachable|joignable|erreichbar|localizable
      |(?:says|saying)\b|\((?:id|ssn|passport|tax|personal|identity|social|national|[\w.+-]+@)|[\w.+-]+@|的|说|报告|负责)"""
)
_THING_BEFORE = re.compile(r"(?ir)\b(?:the|this|both|der|die|das|dem|los|las|les|storm|survey boat|boat|ship|hurricane|tempest|temp[êe]te|sturm|tormenta|river|mouth of the|on the|of the|above|below|near|at|in|bei|an der|auf der|zu|sur|sur la|de la rivi[èe]re|rivi[èe]re|del r[íi]o|r[íi]o|rio|em|à|en|re: sed\d+,|station|the weir at|see the)\s+$")

# --- identity numbers --------------------------------------------------------------------------
_ID = re.compile(r"(?<![\p{L}\p{N}./+#-])(?:\d{2}[. ]\d{3}[. ]\d{3}[- ]\p{Lu}|\d{2,4}-\d{3}-\d{2,3}-\p{Lu}|\d{3}-\d{2}-\d{4}|\d{6}/\d{3,4}|\p{Lu}{1,3}\d{6,9}\p{Lu}?|\d{8}-?\p{Lu}|\d{3}\.\d{3}\.\d{3}-\d{2}|\d{1,2} ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?|\d{2}(?: \d{3}){2,3}|\p{Lu}{2}(?: ?\d{2}){3} ?\p{Lu}|\p{Lu}{2}\d{2}(?: ?[\p{Lu}\d]{4}){3,7}(?: ?[\p{Lu}\d]{1,3})?|\d{17}[\dXx]|\d{9,12}|[\p{Lu}\d](?:[\p{Lu}\d]|[-./](?=[\p{Lu}\d])){5,16})(?![\p{L}\p{N}]|[-/]\d|\.\d)")
_ID_LABEL = re.compile(
    r"""(?ixr)(?:passport|passeport|pasaporte|passaporte|reisepass|pass-?nr|ausweis\w*|personalausweis\w*|id[\ -]?card|identity\ card|identity\ (?:no\.?|number)|national\ id(?:entity)?|personal\ (?:no\.?|number|id)|tax\ (?:no\.?|number|id)|taxpayer\ \w+|social\ security|ssn|nino|ni\ number
      |steuer-?(?:nummer|nr|id\w*)|sozialversicherungs\w*|sv-?nummer|rentenversicherungs\w*|carte\ (?:nationale\ )?d['’]identit[ée]|pi[èe]ce\ d['’]identit[ée]|num[ée]ro\ fiscal|n[°o]\.?\ fiscal|s[ée]curit[ée]\ sociale|nir|insee|dni|nie|nif|cif|c[ée]dula|documento(?:\ de\ identidad(?:e)?)?|carn[ée](?:t)?\ de\ identidad|n[úu]mero\ fiscal|seguridad\ social|seguran[çc]a\ social|cpf|rg|contribuinte|cart[ãa]o\ de\ cidad[ãa]o|bilhete\ de\ identidade|identidade|identidad
      |身份证(?:号码|号)?|护照(?:号码|号)?|税号|社保号|证件号|iban)(?:\s*(?:n[°ºo]\.?|nr\.?|no\.?|num(?:ber|[ée]ro|ero)?|n[úu]mero|nummer|号|号码|card|id))?\s*[:：\#=-]?\s*\(?$"""
)
_THING_LABEL = re.compile(r"(?ir)(?:inventory|library|call number|gauge|gauging|sheet|bottle|sensor|serial|\bsn\b|spectrum|file|box|report|version|checksum|catalogue|cote|num[ée]ro de jaugeage|capteur|flacon|aforo|hoja|expediente|botella|sensor|aktenzeichen|pegelnummer|flasche|sonde|posto|drenagem|folha|frasco|站号|瓶|record|station|index|order|invoice|batch)[^.;:\n]{0,22}$")

# --- phone numbers -----------------------------------------------------------------------------
_PHONE = re.compile(r"(?<![\p{L}\p{N}./#-])(?:(?:\+|00)\s?\d{1,3}(?:[ .\-/]?\(0\))?[ .\-/]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .\-/]?\d{1,5}){1,6}|\(0?\d{2,5}\)[ .\-/]?\d{2,5}(?:[ .\-/]\d{2,5}){0,4}|0\d{1,5}(?:[ .\-/]\d{1,6}){1,5}|0\d{9,10}|\d{3}[-. ]\d{3}[-. ]\d{4}|\d{2,3}(?: \d{2,3}){2,4})(?![\p{L}\p{N}]|[-/]\d|[.,]\d)")
_PHONE_LABEL = re.compile(r"(?ir)(?:phone|tel(?:e(?:fon|fono|phone)|[ée]fono|[ée]l[ée]phone|efone)?|t[ée]l|mobile?|m[óo]vil|celular|handy|portable|cell|fax|call(?:ed from)?|rung at|ring|reachable (?:under|at|on)|joignable au|erreichbar unter|unter|contact|whatsapp|ligar|llamar(?: al)?|avis[ao]\w*|rufen|appeler|au|al|from|at|电话|手机|致电|拨打|by phone(?: to)?|localizable en el)\s*\.?\s*[:：]?\s*(?:n[°ºo]\.?\s*)?$")

# --- mail --------------------------------------------------------------------------------------
_AT = r"(?:\s*[(\[{<]\s*(?:at|@|arroba|arobase|chez|bei)\s*[)\]}>]\s*|\s+(?:at|arroba|arobase)\s+|\s?[@＠]\s?)"
_DOT = r"(?:\s*[(\[{<]\s*(?:dot|punkt|point|punto|ponto|\.)\s*[)\]}>]\s*|\s+(?:dot|punkt|punto|ponto)\s+|\.)"
_MAIL = re.compile(rf"(?i)(?<![\p{{L}}\p{{N}}._%+@-])[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}_%+'’-]|{_DOT}(?=[\p{{L}}\p{{N}}]))*{_AT}(?:[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?{_DOT})+\p{{L}}{{2,24}}(?![\p{{L}}\p{{N}}@-])")
_PLAIN_MAIL = re.compile(r"(?<![\p{L}\p{N}._%+@-])[\p{L}\p{N}](?:[\p{L}\p{N}._%+'-]*[\p{L}\p{N}_+-])?@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+\p{L}{2,24}(?![\p{L}\p{N}@-])")
_DISGUISE = re.compile(r"(?i)[(\[{<]\s*(?:at|@|arroba|arobase|chez|bei)\s*[)\]}>]|\s(?:at|arroba|arobase)\s+[\p{L}\p{N}-]+\s*(?:[(\[{<]\s*)?(?:dot|punkt|punto|ponto)\b|＠|@\s|\s@|@[^\s@]*(?:[(\[{<]|\s(?:dot|punkt|punto|ponto)\s)")
_SPACED_AT = re.compile(r"(?i)\s(?:at|arroba|arobase)\s")

# --- addresses ---------------------------------------------------------------------------------
_UNIT_EN = r"(?:flat|apt|apartment|suite|ste|unit|room|floor|no)\.?[ ]*\#?\d{1,4}[A-Za-z]?"
_STREET_EN = r"street|str|st|road|rd|avenue|ave|av|boulevard|blvd|drive|dr|lane|ln|court|ct|close|cl|row|way|hill|place|pl|square|sq|terrace|ter|crescent|cres|gardens?|grove|walk|parade|quay|wharf|mews|rise|green|alley|highway|hwy|parkway|pkwy"
_NO = r"\d{1,4}(?:\s?-\s?\d{1,4})?(?:\s?-?\s?[A-Za-z](?![\p{L}]))?"
#: The kinds of address, in the order in which they are tried.
_ADDRESS_KINDS = {
    "english": rf"""(?:(?i:{_UNIT_EN})[^\S\r\n]*,[^\S\r\n]*)?{_NO}[^\S\r\n]+(?:(?:St\.|SAINT|Saint|ST\.)[^\S\r\n]+)?(?:{_UP}[\p{{L}}'’-]*\.?[^\S\r\n]+){{0,3}}?(?:{_UP}[\p{{L}}'’-]*[^\S\r\n]+)(?i:{_STREET_EN})\b(?:\.(?=,))?(?:[^\S\r\n]*,[^\S\r\n]*(?i:{_UNIT_EN})(?![\p{{L}}\p{{N}}]))?""",
    "french": rf"""{_NO}(?:[^\S\r\n]*(?i:bis|ter|quater)\b)?[^\S\r\n]*,?[^\S\r\n]+(?i:rue|avenue|av\.|boulevard|bd|quai|chemin|place|all[ée]e|impasse|route|cours|passage|sentier|square|ruelle|faubourg)[^\S\r\n]+(?:(?i:de[^\S\r\n]+la|de[^\S\r\n]+l['’]|du|des|de|d['’]|le|la|les|l['’]|aux?|à)[^\S\r\n]*)*{_UP}[\p{{L}}'’-]*(?:[^\S\r\n]+(?:(?i:de[^\S\r\n]+la|du|des|de|et)[^\S\r\n]+)?{_UP}[\p{{L}}'’-]*){{0,3}}(?:[^\S\r\n]*,[^\S\r\n]*(?i:apt|appt|appartement|app|b[âa]t|[ée]tage|porte)\.?[^\S\r\n]*\w{{1,4}})?""",
    "romance": rf"""(?i:calle|c/|avenida|avda\.?|av\.|paseo|p[º°]|plaza|pza\.?|camino|carretera|ronda|traves[íi]a|cuesta|pasaje|rua|travessa|tv\.|largo|pra[çc]a|alameda|estrada|beco|rodovia|via|viale|piazza|corso)[^\S\r\n]*(?:(?i:de[^\S\r\n]+la|de[^\S\r\n]+los|de[^\S\r\n]+las|del|de|da|do|das|dos|la|el|los|las)[^\S\r\n]+)*{_UP}[\p{{L}}'’.-]*(?:[^\S\r\n]+(?:(?i:de[^\S\r\n]+la|del|de|da|do|das|dos|y|e)[^\S\r\n]+)?{_UP}[\p{{L}}'’.-]*){{0,3}}[^\S\r\n]*,?[^\S\r\n]*(?:(?i:n[º°.]|n[úu]m\.?|no\.?)[^\S\r\n]*)?\d{{1,4}}(?:[^\S\r\n]?-?[A-Za-z](?![\p{{L}}]))?(?:[^\S\r\n]+(?i:bis|ter))?(?:[^\S\r\n]*[,–-][^\S\r\n]*(?:\d{{1,2}}[^\S\r\n]*[º°ª]\.?(?:[^\S\r\n]*[A-Za-z](?![\p{{L}}])|[^\S\r\n]*(?i:izq|dcha|dto|esq)\.?)?|(?i:ap(?:to|t|\.)?|apartamento|piso|puerta|bloco|bloque|casa|sala|loja|andar|esc)\.?[^\S\r\n]*\d{{1,4}}[^\S\r\n]?[A-Za-z]?(?![\p{{L}}])))*""",
    "german": rf"""(?:(?:{_UP}[\p{{L}}-]+[^\S\r\n]+)?{_UP}[\p{{L}}-]*?(?i:stra(?:ß|ss)e|str\.|gasse|weg|platz|allee|ufer|damm|ring|steig|pfad|markt|graben|hof|chaussee|brücke)|(?i:(?:alte|neue|obere|untere|kleine|gro(?:ß|ss)e|lange|hohe)[rnsm]?)[^\S\r\n]+{_UP}[\p{{L}}-]*?(?i:stra(?:ß|ss)e|str\.|gasse|weg|platz|allee|ufer|damm|ring|steig|pfad|markt|graben|hof)|(?:Am|An[^\S\r\n]+der|An[^\S\r\n]+den|Im|In[^\S\r\n]+der|Auf[^\S\r\n]+der|Auf[^\S\r\n]+dem|Zum|Zur|Unter[^\S\r\n]+den|Hinter[^\S\r\n]+der)[^\S\r\n]+{_UP}[\p{{L}}-]+(?:[^\S\r\n]+{_UP}[\p{{L}}-]+)?)[^\S\r\n]+\d{{1,4}}(?:[^\S\r\n]?[a-zA-Z](?![\p{{L}}]))?(?:[^\S\r\n]*[,/][^\S\r\n]*(?i:whg|wohnung|top|app|apt|etage|stock|[0-9]\.[^\S\r\n]*stock|zi)\.?[^\S\r\n]*\d{{0,4}}[a-z]?)?""",
    "chinese": rf"""[\p{{Han}}]{{1,12}}(?:路|街|大道|巷|胡同)[^\S\r\n]*\d{{1,5}}[^\S\r\n]*号(?:[^\S\r\n]*\d{{1,3}}[^\S\r\n]*(?:栋|楼|单元|室|号楼))*""",
}
# What a text, in lower case, must hold somewhere for a kind of address to be in it: kinds that cannot occur are left out of the pattern.
_ADDRESS_NEEDS = {
    "french": "rue|avenue|av.|boulevard|bd|quai|chemin|place|allée|allee|impasse|route|cours|passage|sentier|square|ruelle|faubourg".split("|"),
    "romance": "calle|c/|avenida|avda|av.|paseo|pº|p°|plaza|pza|camino|carretera|ronda|travesía|travesia|cuesta|pasaje|rua|travessa|tv.|largo|praça|praca|alameda|estrada|beco|rodovia|via|viale|piazza|corso".split("|"),
    "german": "straße|strasse|str.|gasse|weg|platz|allee|ufer|damm|ring|steig|pfad|markt|graben|hof|chaussee|brücke|am |an d|im |in d|auf d|zum |zur |unter d|hinter d".split("|"),
    "chinese": ["号"],
}
_GERMAN = re.compile(r"(?i:stra(?:ß|ss)e|str\.|gasse|weg|platz|allee|ufer|damm|ring|steig|pfad|markt|graben|hof|chaussee|brücke)[^\S\r\n]+\d|\b(?:A[mn]|I[mn]|Auf|Zu[mr]|Unter|Hinter)[^\S\r\n]")


def _address_kinds(t: str) -> tuple[str, ...]:
    low = t.lower()
    kinds = [k for k in _ADDRESS_KINDS if k not in _ADDRESS_NEEDS or any(w in low for w in _ADDRESS_NEEDS[k])]
    return tuple(k for k in kinds if k != "german" or _GERMAN.search(t))


@functools.cache
def _address(kinds: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?x)(?<![\p{{L}}\p{{N}}./-])(?:{'|'.join(_ADDRESS_KINDS[k] for k in kinds)})(?![\p{{L}}\p{{N}}])")


_DIGIT = re.compile(r"\d")
_SHORT_STREET = re.compile(r"(?i)\b(?:str|st|rd|ave|av|blvd|dr|ln|ct|cl|pl|sq|ter|cres|hwy|pkwy)$")

# Words that no street name holds between its number and its kind.
_FILLER = frozenset("on the was is of in at and for with from to by broke read values days".split())


def _plain(word: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFKD", word.lower().replace("ø", "o").replace("ł", "l").replace("ß", "ss")) if not unicodedata.combining(c))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return len(digits) > 1 and total % 10 == 0


def mod97(text: str) -> bool:
    """IBAN check: country and check digits moved to the end, letters as numbers, remainder 1."""
    t = re.sub(r"[^A-Z0-9]", "", text.upper())
    if not re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", t):
        return False
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def mod11(digits: str) -> bool:
    """Whether the last of eleven digits checks the others (weights 10..2 from the tenth, twice)."""
    if len(digits) != 11:
        return False
    first = sum(int(c) * w for c, w in zip(digits, range(10, 1, -1))) * 10 % 11 % 10
    second = sum(int(c) * w for c, w in zip(digits, range(11, 1, -1))) * 10 % 11 % 10
    return digits[9:] == f"{first}{second}"


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _mails(t: str):
    if "@" in t or "＠" in t:
        at = -1
        done = 0
        while (at := t.find("@", at + 1)) >= 0:
            # a local part has at most 64 characters, a domain 255
            for m in _PLAIN_MAIL.finditer(t, max(done, at - 65), at + 256):
                if m.start() < at < m.end():
                    yield m.start(), m.end(), 3.0
                    done = m.end()
                    break
    if _DISGUISE.search(t):
        for m in _MAIL.finditer(t):
            g = m.group()
            if _SPACED_AT.search(g) and not re.search(r"(?i)\s(?:dot|punkt|punto|ponto)\s|[(\[{<]", g):
                continue  # "at" as a word, and nothing else in disguise
            yield m.start(), m.end(), 2.5


def dated_luhn(digits: str) -> bool:
    """Thirteen digits that begin with a date (yymmdd) and end in a Luhn digit, as identity numbers with a birth date do."""
    return len(digits) == 13 and "01" <= digits[2:4] <= "12" and "01" <= digits[4:6] <= "31" and luhn(digits)


def mod11_2(text: str) -> bool:
    """Eighteen characters with a birth date and a check character by ISO 7064 mod 11-2."""
    if not re.fullmatch(r"\d{6}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx]", text):
        return False
    total = 0
    for c in text[:17]:
        total = (total + int(c)) * 2 % 11
    return (12 - total) % 11 == (10 if text[17] in "Xx" else int(text[17]))


def key97(digits: str) -> bool:
    """Fifteen digits: sex, year and month of birth first, and a key that makes the number's remainder by 97."""
    return len(digits) == 15 and digits[0] in "12" and "01" <= digits[3:5] <= "12" and 97 - int(digits[:13]) % 97 == int(digits[13:])


def letter23(text: str) -> bool:
    """Eight digits and the letter that their remainder by 23 gives."""
    m = re.fullmatch(r"(\d{8})-?([A-Z])", text)
    return bool(m) and "TRWAGMYFPDXBNJZSQVHLCKE"[int(m[1]) % 23] == m[2]


def _checked(g: str, d: str) -> float:
    """What check digits add: those of two digits, or with a date inside, confirm a number alone; one digit in ten or a letter in 23
    confirms only beside something else."""
    n = len(d)
    if n >= 12 and g[:2].isalpha() and mod97(g) or n == 15 and key97(d) or n >= 17 and mod11_2(g) or n == 13 and dated_luhn(d) or n == 11 and "." in g and mod11(d) and len(set(d)) > 1:
        return 1.0
    if n == 8 and letter23(g):
        return 0.5
    return 0.2 if n >= 12 and luhn(d) else 0.0


def _ids(t: str):
    for m in _ID.finditer(t):
        g = m.group()
        d = _digits(g)
        if len(d) < 5:
            continue
        score = _checked(g, d)
        before = t[max(0, m.start() - 60) : m.start()]
        if _ID_LABEL.search(before):
            score += 1.2
        if score >= THRESHOLD and _THING_LABEL.search(before):
            score -= 1.5
        if score >= THRESHOLD:
            yield m.start(), m.end(), score


def _phones(t: str):
    for m in _PHONE.finditer(t):
        g = m.group()
        n = len(_digits(g))
        if not 7 <= n <= 15:
            continue
        before = t[max(0, m.start() - 48) : m.start()]
        score = 0.0
        if re.match(r"\+", g) or re.match(r"00\d", g) and re.search(r"[ ./-]", g):
            score += 1.0
        elif g[0] == "(" and n >= 9:
            score += 1.0
        elif g[0] == "0" and n >= 9:
            score += 0.8 if re.search(r"[ ./-]", g) else 0.5
            if re.fullmatch(r"0\d{3,4}[ /-]\d{3}[ -]?\d{3}|0\d{4} ?\d{6}|0\d{1,4}/\d{3,8}(?:-\d{1,5})?|0\d(?:[ .]\d\d){4}|0\d{2,4} \d{3,4} \d{3,4}", g):
                score += 0.3
        elif re.fullmatch(r"\d{3}[-. ]\d{3}[-. ]\d{4}", g):
            score += 0.7 if g[0] in "23456789" else 0.3
            if re.fullmatch(r"\d{3}-555-\d{4}", g):
                score += 0.3
        else:
            score += 0.2
        labelled = _PHONE_LABEL.search(before)
        if labelled:
            score += 0.9
        line = t.rfind("\n", 0, m.start()) + 1
        if not t[line : m.start()].strip() and (t[m.end() :].lstrip(" ")[:1] in ("\n", "", "\r")):
            score += 0.4  # alone on its line, as under a letter
        if not labelled and _THING_LABEL.search(before) or _ID_LABEL.search(before):
            score -= 1.5
        if re.fullmatch(r"\d{1,2}[./-]\d{1,2}[./-]\d{2,4}", g):
            score -= 1.0
        if score >= THRESHOLD:
            yield m.start(), m.end(), score


def _addresses(t: str):
    if not _DIGIT.search(t):
        return
    for m in _address(_address_kinds(t)).finditer(t):
        g = m.group()
        end = m.end()
        if any(w.lower() in _FILLER for w in re.findall(r"\p{L}+", g)[:-1]) and re.match(r"\D*\d+\S*\s+\p{Lu}", g):
            continue
        if t[end : end + 1] == "." and _SHORT_STREET.search(g):
            # the full stop of a short form, unless it is that of the sentence
            line = t.rfind("\n", 0, m.start()) + 1
            alone = not t[line : m.start()].strip() and t[end + 1 : end + 2] in ("", "\n", "\r")
            if t[end + 1 : end + 2] in (".", ",", ";") or alone:
                end += 1
        yield m.start(), end, 1.5


def _is_thing(*words: str) -> bool:
    return any(_plain(w).strip(".") in NOT_PERSON or re.match(r"[LlDd]['’]\p{Ll}|L['’]", w) for w in words)


#: What speaks for a name, added up to the threshold of 1: its form (two capitalised words, no thing; initials), a given name of the fixed
#: list, a given name as the corpus itself uses it, words that announce a person or follow one, a line of its own.
FORM, INITIALS, LISTED, LEARNED, ANNOUNCED, WEAKLY, FOLLOWED, ALONE = 0.35, 0.4, 0.35, 0.65, 0.7, 0.6, 0.65, 0.3


def _evidence(given: str, learned: frozenset) -> float:
    parts = [_plain(p) for p in given.split("-")]
    return (LISTED if any(p in GIVEN for p in parts) else 0.0) + (LEARNED if any(p in learned for p in parts) else 0.0)


def _shouts(text: str) -> bool:
    upper, lower = sum(c.isupper() for c in text), sum(c.islower() for c in text)
    return upper > 3 * lower


class Candidate(NamedTuple):
    """A possible name as one reading of the text shows it; what the corpus knows of its given name is added later."""

    titled: bool  # right after a title: the first of those at one start that stands is taken
    start: int
    end: int
    score: float  # without what is learned
    given: str
    second: str  # a word that may be a second given name: the name then reaches to ``longer``
    longer: int
    needs: bool  # stands only if its given name is known
    thing: bool  # words before it announce a thing


def _name_candidates(t: str, counts: Counter | None = None) -> list[Candidate]:
    """All candidates of a text. ``counts`` takes, of each capitalised word that begins a pair: its pairs, and its pairs after
    a title or an announcing word; pairs in capitals are left out."""
    out: list[Candidate] = []

    def count(given: str, surname: str, strong: bool) -> None:
        if counts is not None and not given.isupper() and not _is_thing(given):
            w = _plain(given.split("-")[0])
            counts[w, 0] += 1
            if strong and not _is_thing(*surname.split("-")):
                counts[w, 1] += 1

    for m in _TITLED.finditer(t):  # after a title the surname alone will do
        at = m.end()
        if m.group().strip() in ("M.", "M") and (w := re.search(r"(\p{Lu}\p{L}+)\s$", t[max(0, m.start() - 40) : m.start()])) and not _is_thing(w[1]):
            continue  # a middle initial
        for pattern in (_BACKWARD, _FORWARD, _SURNAME):
            k = pattern.match(t, at)
            if not k:
                continue
            if pattern is not _SURNAME:
                given = "" if k["g"].endswith(".") else k["g"]
                if _is_thing(k["s"], *([given] if given else [])):
                    continue
                if given:
                    count(given, k["s"], True)
                out.append(Candidate(True, k.start(), k.end(), 2.0, given, "", 0, bool(given) and (pattern is _BACKWARD or "\n" in k.group()), False))
            # M. is a title before a whole name only; before a surname it is an initial
            elif not _is_thing(k["s"]) and m.group().strip() not in ("M.", "M"):
                out.append(Candidate(True, k.start("s"), k.end("s"), 2.0, "", "", 0, False, False))
    for pattern in (_BACKWARD, _FORWARD):
        at = 0
        while (m := pattern.search(t, at)) is not None:
            at = m.start() + 1
            while at < len(t) and t[at].isalpha():
                at += 1
            given, surname = m["g"], m["s"]
            initials = given.endswith(".")
            before, after = t[max(0, m.start() - 70) : m.start()], t[m.end() : m.end() + 40]
            announced = _BEFORE.search(before)
            if not initials:
                count(given, surname, bool(announced))
            if _is_thing(*([] if initials else [given]), *surname.split("-")):
                continue
            weak = bool(announced) and bool(_WEAK.search(before))
            # among capitals the form says nothing
            shouted = given.isupper() and surname.isupper() and not initials and _shouts(before[-40:] + after)
            score = INITIALS if initials else 0.0 if shouted else FORM
            if announced:
                score += WEAKLY if weak else ANNOUNCED
            if _AFTER.match(after):
                score += FOLLOWED
            line = t.rfind("\n", 0, m.start()) + 1
            if not t[line : m.start()].strip() and after.lstrip(" \r")[:1] in ("\n", ""):
                score += ALONE
            thing = not announced and bool(_THING_BEFORE.search(before))
            if score + (0.0 if initials else LISTED + LEARNED) - (0.5 if thing else 0.0) < THRESHOLD - 1e-9:
                continue
            second, longer = "", 0
            if pattern is _FORWARD and not initials and not m["m"]:
                # two given names: the second may be the surname's place only if nothing longer starts there
                nxt = _FORWARD.match(t, m.start("s"))
                if nxt and not _is_thing(nxt["s"]) and not re.match(r"[.,;:]", t[m.end("s") : m.end("s") + 1]):
                    second, longer = surname, nxt.end()
            out.append(Candidate(False, m.start(), m.end(), score, "" if initials else given, second, longer, pattern is _BACKWARD and not (initials or (announced and not weak)), thing))
    return out


def _settled(candidates: list[Candidate], learned: frozenset) -> list[tuple[int, int]]:
    """The spans of the candidates that stand."""
    out, last = [], -1
    for c in candidates:
        if c.titled and c.start != last and not (c.needs and not _evidence(c.given, learned)):
            last = c.start
            out.append((c.start, c.end))
    taken = sorted(out)
    for c in candidates:
        if c.titled or _meets(taken, c.start, c.end):
            continue
        known = _evidence(c.given, learned) if c.given else 0.0
        if c.needs and not known or c.score + known - ((0.5 if known else 0.8) if c.thing else 0.0) < THRESHOLD - 1e-9:
            continue
        span = (c.start, c.longer if c.second and known and _evidence(c.second, learned) else c.end)
        bisect.insort(taken, span)
        out.append(span)
    return out


def _meets(spans: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether any of the spans (in order, without overlaps) overlaps s..e."""
    k = bisect.bisect_left(spans, (e, e))
    return k > 0 and spans[k - 1][1] > s


def _proposed(text: str, counts: Counter | None = None) -> tuple[list[tuple[int, int, int]], list[Candidate]]:
    """(type, start, end) of all but names, and the candidates for names."""
    spans = [(k, s, e) for k, finder in enumerate((_mails, _ids, _phones, _addresses)) for s, e, score in finder(text) if score >= THRESHOLD - 1e-9]
    return spans, _name_candidates(text, counts)


def _resolved(spans: list[tuple[int, int, int]], candidates: list[Candidate], learned: frozenset) -> list[tuple[str, int, int]]:
    """Of overlapping spans the stronger type, of one type the longer."""
    taken: list[tuple[int, int]] = []
    kinds: list[str] = []
    names = [(len(TYPES) - 1, s, e) for s, e in _settled(candidates, learned)]
    for k, s, e in sorted([*spans, *names], key=lambda p: (p[0], -(p[2] - p[1]), p[1])):
        if not _meets(taken, s, e):
            at = bisect.bisect_left(taken, (s, e))
            taken.insert(at, (s, e))
            kinds.insert(at, TYPES[k])
    return [(k, s, e) for k, (s, e) in zip(kinds, taken)]


def find(text: str | None, learned: frozenset = frozenset()) -> list[tuple[str, int, int]]:
    """(type, start, end) of each occurrence, in code points, end exclusive, without overlaps, in order of start."""
    return _resolved(*_proposed(text), learned) if text else []


def mask(text: str | None, learned: frozenset = frozenset()) -> str | None:
    """The text with each occurrence replaced by its type in brackets, such as [EMAIL]."""
    if not text:
        return text
    out, at = [], 0
    for kind, s, e in find(text, learned):
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


#: Most given names that are learned: those most often announced. Bounds what is broadcast (under 4 MB) whatever the corpus.
VOCABULARY = 200_000

_SPAN = pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])
_KINDS = dict(zip(Candidate._fields, ("boolean", "int", "int", "double", "string", "string", "int", "boolean", "boolean")))
_NAME = pa.struct([(f, {"boolean": pa.bool_(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[t]) for f, t in _KINDS.items()])
_WORD = pa.struct([("w", pa.string()), ("pairs", pa.int64()), ("strong", pa.int64())])


def _read(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Each text read once: its spans and candidates, and a row a batch with the counts of its capitalised words."""
    kind = df.schema[doc_id].dataType.simpleString()
    names = f"array<struct<{', '.join(f'{f}: {t}' for f, t in _KINDS.items())}>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter = Counter()
            spans, found = [], []
            for t in b.column(1):
                a, c = _proposed(t.as_py() or "", counts)
                spans.append([{"k": k, "s": s, "e": e} for k, s, e in a])
                found.append([x._asdict() for x in c])
            n = b.num_rows
            words = [{"w": w, "pairs": counts[w, 0], "strong": counts[w, 1]} for w in {w for w, _ in counts}]
            ids = b.column(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(_NAME)), pa.nulls(n, pa.list_(_WORD))], names=["id", "spans", "names", "words"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, ids.type), pa.nulls(1, pa.list_(_SPAN)), pa.nulls(1, pa.list_(_NAME)), pa.array([words], pa.list_(_WORD))], names=["id", "spans", "names", "words"])

    src = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return materialize(src.mapInArrow(run, f"id {kind}, spans array<struct<k: int, s: int, e: int>>, names {names}, words array<struct<w: string, pairs: bigint, strong: bigint>>"))


def _given_names(read: DataFrame, least: int = 3, share: float = 0.2) -> frozenset:
    """Given names as the corpus uses them, without accents, in lower case: words that begin a capitalised pair right after a title or
    a word that announces a person at least ``least`` times, and in at least ``share`` of all their pairs. Counted over all texts."""
    c = read.filter("words is not null").select(F.explode("words").alias("x")).groupBy("x.w").agg(F.sum("x.pairs").alias("pairs"), F.sum("x.strong").alias("strong"))
    c = c.filter((F.col("strong") >= least) & (F.col("strong") >= share * F.col("pairs")))
    return frozenset(r["w"] for r in c.orderBy(F.col("strong").desc(), "w").limit(VOCABULARY).select("w").collect())


def given_names(df: DataFrame, text: str = "text") -> frozenset:
    return _given_names(_read(df.withColumn("_id", F.lit(0)), "_id", text))


def _resolve_row(spans, names, learned: frozenset) -> list[tuple[str, int, int]]:
    return _resolved([(x["k"], x["s"], x["e"]) for x in spans], [Candidate(**x) for x in names], learned)


def find_pii(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each occurrence: doc_id, entity_type, start_offset, end_offset (code points, end exclusive).

    Each text is read once and whole: spans, candidates for names and counts of capitalised words go to the shared folder. From the
    counts follows which words this corpus uses as given names, and with that the candidates are settled.
    Null, empty and blank texts give no row; repeated rows of the input give repeated rows; other columns are not read.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    read = _read(df.filter(F.col(text).isNotNull() & (F.col(text) != "")), doc_id, text)
    learned = df.sparkSession.sparkContext.broadcast(_given_names(read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, what, start, end = [], [], [], []
            for i, spans, names in zip(*(c.to_pylist() for c in b.columns)):
                for k, s, e in _resolve_row(spans, names, learned.value):
                    ids.append(i)
                    what.append(k)
                    start.append(s)
                    end.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(what, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=["doc_id", "entity_type", "start_offset", "end_offset"])

    rows = read.filter("spans is not null and (size(spans) > 0 or size(names) > 0)").select("id", "spans", "names")
    return rows.mapInArrow(run, f"doc_id {kind}, entity_type string, start_offset int, end_offset int").withColumnRenamed("doc_id", doc_id)


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """The frame with ``text`` masked; null stays null. Given names are learned from the same texts."""
    learned = df.sparkSession.sparkContext.broadcast(given_names(df, text))

    @F.pandas_udf("string")
    def masked(t: pd.Series) -> pd.Series:
        return t.map(lambda x: mask(x, learned.value), na_action="ignore")

    return df.withColumn(text, masked(F.col(text)))
