"""Records that hold template residue, filler, error messages or script notices instead of content.

Texts are cut into messages (sentences, lines). In each of them, whatever it says and
whatever stands beside it, numbers, addresses, dates, names and placeholders are masked,
and equal masked messages are grouped by an exact hash over all sources. A hash carries
what phrase and placeholder rules say of its message; they classify the groups:

* A notice is made of notice words. Its *phrases* are stems of what such messages say
  happened or ask for (not found, denied, expired, turn on), its *company* the words that
  go with them (page, server, please, later). A message with a phrase, three quarters of
  whose words are notice words, is a notice wherever it stands; from three fifths, or if it
  opens with a phrase and goes on in words of its own, it is one if it recurs widely: a
  group that the rules call a notice, or a doubtful one, on a share of all sources and on
  most of its own, is a notice in all its places. No message is listed as a whole.
* An unfilled place is a placeholder that stands where a value belongs; how many sources
  have it doesn't clear it.
* A mention speaks of templates, forms or manuals and shows a placeholder, or quotes a
  phrase; code shows, too.
* All else is content, or an aside that is neither (bylines, headings, request numbers).

A record is residue if it has an unfilled place, or a notice and no content. Headline
and boilerplate of pages are left out first, by the template of their host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import boilerplate
from pagemill.session import bounded_broadcast, stored

#: Share of all sources from which a masked message recurs widely, and the fewest sources that can show it.
WIDE_SHARE, WIDE_LEAST = 0.01, 3
#: Share of notice words that makes a message with a phrase a notice, and the one that does so if it recurs widely.
COVERED, COVERED_IF_WIDE = 0.75, 0.6

_PLACE = re.compile(
    r"\{\{\{?\s*[\w.$]+\s*\}?\}\}|\{\$[\w.]+\}|\$\{[\w.]+\}|\$[A-Za-z_]{3,}\$|%%[A-Za-z_]{3,}%%|%[A-Z_]{3,}%|%\(\w+\)[sd]|\[%\s*\w+\s*%\]|\[\[\s*[\w ]+\s*\]\]|@@\w+@@"
    r"|__[A-Z][A-Z_]+__|##[A-Z_]{3,}##|«[A-Z_]{3,}»|\*\*\*[A-Z_]{3,}\*\*\*|#\{[\w.]+\}|\{%[^%{}]*%\}|<%=?\s*[\w.]+\s*%>|<(?!(?:title|body|html|head|div|code|pre|table|script|style|link|meta|form|input|label|span|strong|small|mark)>)[a-z]{4,}(?:_[a-z]+)*>|\{\d\}|\{[a-z]+_?[a-z]*\}|\[INSERT [A-Z_ ]+ HERE\]|\[Your [\w ]+ here\]|\[(?:Insert|Enter|Add) [\w ]+\]"
)

# Residue of templates that were filled with nothing.
_UNFILLED = re.compile(
    r"undefined\s*[–:-]\s*undefined|\(NaN \w+\)|\[object Object\]|<title> placeholder|description placeholder|XXX [\w ]+ XXX|\bXX\.XX\b|TODO: write \w+|^null: "
    r"|^hello ?, thanks for visiting ?\.|^welcome to ?, ?!",
    re.I,
)

#: What every unfilled template has one of, and a mark of every placeholder.
def _may_be_unfilled(low: str) -> bool:
    return (
        "undefined" in low or "(nan" in low or "[object" in low or "placeholder" in low or "xxx " in low or "xx.xx" in low or "todo: write" in low or "null: " in low
        or "thanks for visiting" in low or "welcome to" in low
    )


_PLACE_MARK = re.compile(r"[{\[%$@_#«*<]")

# Stems of the phrases of notices in the languages of the pages.
_PHRASES = (
    # English
    "not (?:be )?found", "\\w+n.t (?:be )?f(?:ou|i)nd", "not exist", "\\w+n.t exist", "no longer (?:exist|available|here|active)\\w*", "not available", "\\w+n.t available", "unavailab", "moved", "removed", "deleted", "mistyped", "error", "went wrong", "fail(?:ed|ure)",
    "denied", "forbidden", "unauthori", "not authori", "permission", "suspend", "expir", "maintenance", "timed? ?out", "time-?out", "overload", "too many", "too busy", "blocked", "rate limit", "disabled", "switched off", "turned off", "out of date", "not support", "unsupported",
    "enabl", "activat", "turn on", "switch on", "allow", "checking your", "checking if", "checking the", "verify", "verif", "confirm (?:that )?you", "not a robot", "are (?:a )?human", "re (?:a )?human", "captcha", "loading", "coming soon", "under construction", "nothing (?:here|to see|found|yet)", "giving up", "default page", "it works", "web server is installed", "no site has been set up",
    "bad (?:request|gateway)", "gone", "invalid", "broken", "offline", "unexpected", "interrupted", "refused", "rejected", "unreachable", "unable to", "can(?:.t|not) (?:be )?(?:found|show|display|reach|connect|open|load|process|complete|access)\\w*", "did not get an answer", "need(?:s)? (?:scripts?|javascript)", "requires? (?:scripts?|javascript)", "try (?:again|later)", "sign in again", "log in again", "is down", "be (?:right )?back", "not implemented", "not allowed",
    "lorem", "ipsum", "dummy", "sample text", "placeholder text", "filler text", "text (?:goes )?here", "your (?:own )?text", "your own words", "replace this", "insert (?:your )?text",
    # German
    "nicht gefunden", "nicht (?:mehr )?(?:existier|vorhanden|verfügbar|erreichbar)\\w*", "gibt es nicht", "fehler", "verweigert", "verboten", "gesperrt", "wartung", "abgelaufen", "aktivieren sie", "schalten sie", "wird (?:gerade )?geprüft", "überprüf", "nicht unterstützt", "veraltet", "bitte warten", "wird geladen", "erneut versuchen", "versuchen sie", "text steht hier", "hier kann ihr text", "ihr text", "blindtext", "beispieltext", "platzhaltertext", "gelöscht", "entfernt", "ungültig", "fehlgeschlagen", "kein roboter",
    # French
    "introuvable", "n.existe (?:plus|pas)", "erreur", "refusé", "interdit", "en maintenance", "expiré", "est survenue", "s.est produite", "activer javascript", "activez", "vérification d", "pas un robot", "indisponible", "suspendu", "chargement", "réessay", "revenez", "votre texte", "texte d.exemple", "texte ici", "supprimée?", "n.est (?:plus|pas) (?:disponible|accessible)", "obsolète", "non autorisé",
    # Spanish
    "no (?:se ha )?(?:encontrad|existe|disponible|está disponible)\\w*", "ya no existe", "denegad", "prohibid", "mantenimiento", "caducad", "ha expirado", "se ha producido", "active javascript", "activar javascript", "habilit", "comprobando", "verificando", "no es un robot", "suspendid", "cargando", "inténtelo", "intente", "texto de ejemplo", "su texto", "texto aquí", "eliminad", "no se puede", "no disponible", "servidor no",
    # Russian
    "не найден", "не существует", "больше нет", "нет на сайте", "ошибк", "запрещ", "закрыт", "обслуживани", "технически", "недоступ", "истекл", "включите", "проверка", "проверяем", "вы не робот", "не робот", "заблокирован", "загрузка", "загружается", "попробуйте", "повторите", "зайдите", "текст здесь", "ваш текст", "удален", "удалён", "не поддерживается", "устарел",
)
# Stems of the words that accompany the phrases.
_COMPANY = (
    "page", "url", "address", "link", "site", "website", "server", "gateway", "upstream", "proxy", "resource", "content", "document", "file", "path", "account", "session", "database", "data", "store", "connect", "request", "browser", "javascript", "script", "cookie", "app", "application", "story", "article", "service", "host", "domain", "system", "access", "http", "status", "code", "internal", "answer", "reply", "response", "area", "country", "region", "establish", "occur", "robot", "human",
    "please", "sorry", "oops", "whoops", "again", "later", "minute", "second", "moment", "back", "shortly", "soon", "log", "login", "sign", "reload", "refresh", "continue", "contact", "administrator", "admin", "support", "return", "home", "homepage", "thank", "patience", "view", "go", "goes", "run", "show", "see", "use", "used", "try", "retry", "reference", "incident", "id", "our", "side", "time", "few", "yet", "look", "want", "ask", "day", "temporar", "current", "take", "get", "wait", "slow", "check", "layout", "text", "paragraph", "word", "own", "replace", "put", "happen", "verif", "set", "exist", "found", "find", "need", "requir", "open", "right", "old", "new", "version",
    "seite", "gewünscht", "angefordert", "gesucht", "zugriff", "adresse", "server", "sitzung", "browser", "später", "noch", "einmal", "erneut", "bitte", "wegen", "vorübergehend", "aufgetreten", "anzuzeigen", "anzeigen", "sehen", "fortfahren", "erreichbar", "versuchen", "anmelden", "hier", "steht", "dienst", "konto", "inhalt", "melden", "zurück", "leider", "ziel", "menschen", "mensch",
    "demandé", "accès", "serveur", "navigateur", "connexion", "adresse", "veuillez", "plus", "tard", "bientôt", "désolé", "merci", "patient", "instant", "afficher", "voir", "poursuivre", "continuer", "insérez", "saisissez", "texte", "exemple", "activer", "contenu", "compte", "reconnect", "recharg", "humain", "quelque",
    "página", "pagina", "solicitad", "acceso", "sitio", "servidor", "navegador", "sesión", "conexión", "dirección", "más", "tarde", "nuevo", "ver", "continuar", "aquí", "texto", "ejemplo", "contenido", "cuenta", "volver", "vuelva", "lamentamos", "sentimos", "favor", "esper", "momento", "humano", "recurso", "error",
    "страниц", "запрошенн", "запрашиваем", "доступ", "сайт", "сервер", "сесси", "сеанс", "браузер", "адрес", "ваш", "пожалуйста", "позже", "позднее", "снова", "продолжить", "чтобы", "просмотр", "увидеть", "здесь", "текст", "произошл", "временно", "идут", "ведутся", "проводятся", "работ", "попытк", "обнов", "войдите", "извините", "человек", "вставьте", "будет", "долж", "вернитесь", "запрос", "найден",
)
# Words that say nothing either way.
_NEUTRAL = frozenset(
    "a an the this that these it its is are was were be been being has have had do does did don t s re ll ve d m n l will would can cannot couldn doesn didn isn aren wasn won may might must should not no nor to of for in on at by from with and or but if you your we us i he she they them as so too very any some all more most just only also now then there here what when where which who how why up out off over under before after between into than "
    "der die das dem den des ein eine einen einem einer es ist sind war wird werden wurde nicht kein keine mehr und oder sie ihr ihre ihren wir uns in im auf zu zum zur mit für von um bei nach aus auch hat haben kann können bis "
    "le la les un une des du de est sont a ont été ce cette ces cet vous nous votre vos notre ne pas pour par sur dans en et ou si que qui se à au aux il elle on y "
    "el los las una unos unas del al lo es son está están ha han sido este esta estos su sus no para por con sin y o si que se en un ya usted "
    "в на не и или что это эта этот эту такой такая такую с по для к от до из у мы вы нет ещё еще уже был была было бы же вас нас".split()
)
# Fragments of notices in scripts without spaces, those that make a phrase first.
_WIDE_PHRASES = ("見つかりません", "ありません", "存在しません", "エラー", "拒否", "禁止", "メンテナンス", "有効にして", "オンにして", "確認して", "確認中", "チェックして", "切れました", "切れて", "期限", "お試し", "停止", "利用できません", "表示できません", "読み込み中", "準備中", "工事中", "サンプル", "ダミー", "テキストを入力", "失敗", "ロボット", "削除", "無効", "入ります")
_WIDE_COMPANY = ("ページ", "お探し", "指定", "要求", "サイト", "サーバー", "サーバ", "アクセス", "ブラウザー", "ブラウザ", "セッション", "アカウント", "コンテンツ", "スクリプト", "リンク", "アドレス", "javascript", "もう一度", "後で", "しばらく", "してから", "発生", "ただいま", "現在", "続ける", "続行", "表示", "ここに", "こちらに", "テキスト", "文章", "本文", "の", "が", "を", "は", "に", "で", "も", "と", "へ", "から", "まで", "して", "した", "しま", "され", "です", "ます", "ません", "でした", "ました", "ください", "下さい", "います", "中", "する", "には", "ため", "た", "か", "い")



def _by_first_letter(patterns: tuple[str, ...]) -> str:
    """The alternation of ``patterns``, each of which begins with a letter or ``\\w+``, as a choice by that letter, in their order."""
    letters = "".join(sorted({p[0] for p in patterns if p[0] != "\\"}))
    rest = lambda c: "|".join(p[1:] if p[0] == c else r"\w*" + p[3:] for p in patterns if p[0] == c or p.startswith(r"\w+"))
    return "|".join([*(f"{c}(?:{rest(c)})" for c in letters), rf"[^\W{letters}](?:{rest('')})"])


_PHRASE = re.compile(rf"(?<!\w)(?:{_by_first_letter(_PHRASES)})\w*")
_WITH = re.compile(r"(?:" + "|".join(sorted(set(_COMPANY), key=len, reverse=True)) + r")(?:s|es|ed|ing|e|es|n|en|r|er|a|o|os|as|y|ion|ions|ily|ly|\w{0,3})?")
_WIDE_PHRASE, _WIDE_WITH = re.compile("|".join(_WIDE_PHRASES)), re.compile("|".join(sorted(_WIDE_PHRASES + _WIDE_COMPANY, key=len, reverse=True)))
_NUMBERED = re.compile(r"\b(?:reference|request id|incident|ref|ray id|trace)\b[:#]?\s*[\w-]*$", re.I)
_ASCII_WORD = re.compile("[a-z]+")
_QUOTED = re.compile("[“„«‹「\"][^“”„«»‹›「」\"]+[”“»›」\"]")
_CODE_BEFORE = re.compile(r"^(?:http|error|fehler|erreur|ошибка|エラー)?[ :]*\d{3}\s*[:–\-.]?\s+")
_CODE_ONLY = re.compile(r"(?:http|error|fehler|erreur|ошибка)?[ :]*[1-5]\d{2}(?: gone| not found)?\s*[:–\-.]?")
_TRACE = re.compile(r"^(?:traceback \(most recent call last\)|file \"[^\"]+\", line \d+|\w*(?:error|exception): .{0,80}$)", re.I)

# Words of filler Latin, and of keyboard filler.
_LATIN = frozenset(
    "ac adipiscing aliquam aliqua amet ante consectetur curabi curabitur do dolo dolor dolore ea eget eiusmod elit enim erat est et eu ex exercitation felis grata habitant id in incididunt ipsum justo labore lacus laoreet leo libero libro ligua ligula "
    "lorem luctus magna malesuada massa mattis mauris minim molestie morbi nec netus nibh nisi nulla nullam nunc odio orci ornare pellentesque placerat porta posuere pretio purus quam quis sapien sed sem semper senectus sim sit sociis sodales solvo suscipit tellus "
    "tempo tempor tincidunt tristique turpis ullamco unda ut varius vel velit venenatis veniam venu vesti vestibulum vitae vivamus volutpat".split()
)
_KEYS = frozenset("aaa asdf asd asdfg bbb blah ccc dfg foo bar baz fgh hjkl jkl qwe qwer qwerty sdf test testing tests uio xxx yyy zzz zxc zxcv lkj".split())

# Words of sentences that show a placeholder, in the languages of the pages.
_MENTION = re.compile(
    r"\b(?:template|templates|placeholder is|formula|form in|chapter|guide|manual|handbook|tutorial|lesson|learners|exercise|syntax|modèle|manuel|gabarit|exercices|formulaire|vorlage|vorlagen|heft erklärt|handbuch|formular|platzhalter|plantilla|plantillas|manual de|formulario|ejercicios|explica)\b"
    r"|шаблон|учебник|справочник|пособи|テンプレート|ひな形|雛形|説明|例題",
    re.I,
)

_ASIDE = re.compile(r"^(?:reference|request id|incident|ref|ray id|trace)\b[:#]?\s*[\w-]*$|^\[image:.*\]$|^!\[.*\]\(.*\)$|^[\W\d_]*$", re.I)
_ASIDE_WORDS = ("reference", "request", "incident", "ref", "ray", "trace")
# the last character of a message, and the white space after it; begins with a set, which is searched for fast
_END = re.compile(r"[.!?…。！？\n](?:(?<=[.!?…])\s+(?![a-zа-яё])|(?<=[。！？])\s*|(?<=\n))")
_TAGS = re.compile(r"</?(?:b|strong|em|i|mark|span)\b[^>]*>", re.I)
_NUM, _HEX = re.compile(r"\d+"), re.compile(r"\b(?=[0-9a-f]*\d)[0-9a-f]{6,}\b")
_URL = re.compile(r"https?://\S+|\b[\w-]+(?:\.[\w-]+)*\.(?:test|example|com|org|net|invalid)\b|(?<=\s)/[\w/.-]+")
# capital and small letters of the Latin, Greek and Cyrillic scripts
_CAPITAL, _SMALL = ("".join(c for c in map(chr, range(0x41, 0x530)) if test(c)) for test in (str.isupper, str.islower))
_NAME = re.compile(rf"(?<=[\w,;“«„] )[{_CAPITAL}][{_SMALL}]{{2,}}\b")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿]")
_WORD = re.compile(r"[^\W\d_]+")


def messages(text: str) -> list[str]:
    if "<" in text:
        text = _TAGS.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    out, start = [], 0
    for end in _END.finditer(text):
        out.append(text[start : end.start() + 1].strip())
        start = end.end()
    out.append(text[start:].strip())
    return [m for m in out if m]


#: Stems of all words that stand in phrases.
_PHRASE_WORD = re.compile("(?:" + "|".join(sorted({w for x in _PHRASES for w in re.findall(r"[^\W\d_]{2,}", re.sub(r"\\w[*+]?|\(\?[:=!]", " ", x))}, key=len, reverse=True)) + r")\w*")


@lru_cache(maxsize=200_000)
def _may_be_notice_word(word: str) -> bool:
    return word not in _NEUTRAL and (_WITH.fullmatch(word) is not None or _PHRASE_WORD.fullmatch(word) is not None)


#: Words of the rules as they are listed, with the endings of plurals only: names often begin like a stem.
_RULE_WORD = re.compile("(?:" + "|".join(sorted(set(_COMPANY), key=len, reverse=True)) + ")|(?:" + "|".join(x for x in sorted(set(_COMPANY), key=len, reverse=True) if len(x) > 3) + ")(?:n|en|s|es)")


@lru_cache(maxsize=200_000)
def _name_mask(name: str) -> str:
    word = name.casefold()
    return name if _RULE_WORD.fullmatch(word) or _PHRASE.fullmatch(word) or _MENTION.search(word) else "N"


#: Marks of a message that only the full rules can judge: of placeholders, unfilled templates and request numbers.
_SPECIAL = re.compile(r"[{\[%$@_#«*<]|undefined|\(nan|placeholder|xxx|xx\.xx|todo:|null:|thanks|welcome|ref|request|incident|ray|trace")
_NAME_AT = re.compile(rf"[{_CAPITAL}][{_SMALL}]{{2,}}\b")
_BEFORE_NAME = re.compile(r"[\w,;“«„]")


def _masked_numbers(s: str) -> str:
    """``s``, which has no placeholder, with addresses, identifiers and numbers masked."""
    if "/" in s or s.find(".", 0, -1) >= 0:
        s = _URL.sub("U", s)
    if _NUM.search(s):
        s = _NUM.sub("0", _HEX.sub("H", s))
    return s


#: Bits of a field of a tally, and the fields: how many words there are, that tell something, that may be notice words, of filler Latin, of keyboard filler; whether there are special marks.
_FIELD = 32
_WORDS, _TELLING, _KNOWN, _LATIN_WORDS, _KEY_WORDS, _MARKS = (_FIELD * i for i in range(6))


def _of(tally: int, field: int) -> int:
    return tally >> field & (1 << _FIELD) - 1


class _Pieces(dict):
    """What is known of a piece of a message between white space: (masked; masked with the name it begins with, if any; whether a name may follow; tally).

    The same pieces come again and again, so no rule reads them twice; memory is bounded by starting anew.
    """

    LIMIT = 100_000

    def __missing__(self, piece: str) -> tuple[str, str | None, bool, int]:
        # white space before the piece, as it has in its message
        s = _masked_numbers(" " + piece)[1:]
        name = _NAME_AT.match(s)
        plain, low = s.casefold(), piece.casefold()
        tally = 1 << _MARKS if _SPECIAL.search(low) else 0
        for w in _WORD.findall(low):
            tally += (1 << _WORDS) + ((w not in _NEUTRAL) << _TELLING) + (_may_be_notice_word(w) << _KNOWN) + ((w in _LATIN) << _LATIN_WORDS) + ((w in _KEYS) << _KEY_WORDS)
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[piece] = plain, (_name_mask(name[0]) + s[name.end() :]).casefold() if name else None, _BEFORE_NAME.match(s[-1]) is not None, tally
        return found


_PIECES = _Pieces()


def _read(message: str) -> tuple[str | None, int]:
    """(the mask, if it follows from the pieces one by one; the tally of the message's words)."""
    pieces = message.split()
    if not pieces:
        return "", 0
    plain, named, follows, tallies = zip(*map(_PIECES.__getitem__, pieces))
    tally = sum(tallies)
    # placeholders have white space, and names follow one blank; an address that is a path needs one before it
    alone = tally >> _MARKS and _PLACE_MARK.search(message) or message.startswith("/") or " ".join(pieces) != message
    if alone:
        return None, tally
    if any(named):
        plain = [n if n and after else p for p, n, after in zip(plain, named, (False, *follows))]
    return " ".join(plain), tally


def mask(message: str) -> str:
    """The message with numbers, addresses, identifiers, names and placeholders masked; words of the rules stay, capitalised or not."""
    masked, _ = _read(message)
    return _mask_whole(message) if masked is None else masked


def _mask_whole(message: str) -> str:
    s = _masked_numbers(_PLACE.sub("\x01", message) if _PLACE_MARK.search(message) else message)
    return " ".join(_NAME.sub(lambda m: _name_mask(m[0]), s).casefold().split())


def _may_be_notice(low: str, tally: int) -> bool:
    """False only if so few words are in the rules that no phrase can bring the message to a notice's share, and it doesn't open as one."""
    n = _of(tally, _KNOWN)
    return n > 0 and ((n + 4) / (_of(tally, _TELLING) + 4) >= COVERED_IF_WIDE or all(_may_be_notice_word(m[0]) for m in islice(_WORD.finditer(low), 2)))


@lru_cache(maxsize=100_000)
def _goes_with(word: str) -> bool:
    return _WITH.fullmatch(word) is not None


def _masked_ids(s: str) -> str:
    if "/" in s or s.find(".", 0, -1) >= 0:
        s = _URL.sub(" ", s)
    return _HEX.sub(" ", s) if _NUM.search(s) else s


def notice_share(message: str, numbered: bool = True, short: bool = True) -> tuple[bool, float]:
    """(whether the message has the phrase of a notice outside quotation marks, the share of notice words among its telling words).

    ``numbered`` is whether the message may end with a request number, ``short`` whether the share is asked for without a phrase, too; else it is then 0.
    """
    low = _masked_ids(_NUMBERED.sub("", message) if numbered else message).casefold()
    if len(_WIDE.findall(low)) > 2:
        low = _ASCII_WORD.sub(lambda m: "" if _goes_with(m[0]) or _PHRASE.fullmatch(m[0]) else m[0], _QUOTED.sub("", low))
        letters = "".join(c for c in low if c.isalpha())
        rest = _WIDE_WITH.sub("", letters)
        return _WIDE_PHRASE.search(letters) is not None, 1 - len(rest) / len(letters) if letters else 0.0
    spans = [m.span() for m in _PHRASE.finditer(_QUOTED.sub(lambda m: "\x00" * len(m[0]), low))]
    if not spans:
        telling = [w for w in _WORD.findall(low) if w not in _NEUTRAL] if short else []
        return False, sum(map(_goes_with, telling)) / len(telling) if telling else 0.0
    told = covered = 0
    for m in _WORD.finditer(low):
        if any(a <= m.start() < b for a, b in spans):
            told, covered = told + 1, covered + 1
        elif m[0] not in _NEUTRAL:
            told += 1
            covered += _goes_with(m[0])
    return True, covered / told if told else 0.0


def opens_as_notice(message: str) -> bool:
    """Whether two notice words or more, a phrase's among them, stand side by side at the beginning, outside quotation marks."""
    low = _QUOTED.sub("\x00", _CODE_BEFORE.sub("", message.casefold().strip()))
    run = []
    for w in low.split():
        m = _WORD.match(w)
        if m is None or not (_goes_with(m[0]) or _PHRASE.fullmatch(m[0])):
            break
        run.append(m[0])
    return len(run) >= 2 and _PHRASE.search(" ".join(run)) is not None


#: Kinds of message; a doubtful one is a notice if it recurs widely.
CONTENT, ASIDE, NOTICE, PLACE, MENTION, UNFILLED, DOUBTFUL_CONTENT, DOUBTFUL_ASIDE = range(8)


def kind_of(message: str, code: bool = False) -> int:
    return _kind(message, code, _read(message)[1])


def _kind(message: str, code: bool, tally: int) -> int:
    low = message.casefold().strip()
    special = tally >> _MARKS
    if special:
        unfilled = _may_be_unfilled(low) and _UNFILLED.search(message) is not None
        if unfilled or _PLACE_MARK.search(message) and _PLACE.search(message):
            if code or message.startswith("<") and message.endswith(">") and not unfilled:
                return MENTION
            if _MENTION.search(message):
                return MENTION
            return UNFILLED if unfilled else PLACE
    if not message[0].isalpha() and _ASIDE.match(message) or low.startswith(_ASIDE_WORDS) and _ASIDE.match(message):
        return NOTICE if _CODE_ONLY.fullmatch(low) and len(message) > 3 else ASIDE
    if _TRACE.match(message) or _CODE_ONLY.fullmatch(low):
        return NOTICE
    if special and low[-1].isalnum():
        low = _NUMBERED.sub("", low)
        tally = _read(low)[1]
    words = _of(tally, _WORDS)
    if words and _of(tally, _LATIN_WORDS) >= 0.8 * words and (words > 2 or "ipsum" in _WORD.findall(low)):
        return NOTICE
    if words and _of(tally, _KEY_WORDS) >= 0.8 * words:
        return NOTICE
    wide = 0 if message.isascii() else len(_WIDE.findall(message))
    content = message[-1] in ".!?…。！？" and (words >= 4 or wide >= 8) or words >= 9 or wide >= 20
    if wide < 3 and not _may_be_notice(low, tally):
        return CONTENT if content else ASIDE
    phrase, share = notice_share(message, special > 0, words <= 8)
    if phrase and share >= COVERED and not _MENTION.search(message):
        return NOTICE
    if phrase and not code and (share >= COVERED_IF_WIDE or opens_as_notice(message)) and not _MENTION.search(message):
        return DOUBTFUL_CONTENT if content else DOUBTFUL_ASIDE
    if share >= COVERED and words <= 8:
        return ASIDE
    return CONTENT if content else ASIDE


#: Bits of what a text's messages are.
HAS_UNFILLED, HAS_NOTICE, HAS_CONTENT = 1, 2, 4
_BITS = {CONTENT: HAS_CONTENT, MENTION: HAS_CONTENT, NOTICE: HAS_NOTICE, PLACE: HAS_UNFILLED, UNFILLED: HAS_UNFILLED}
#: Low bits of a message's hash in which its kind stands.
KIND_BITS = 3


@lru_cache(maxsize=100_000)
def message_hash(message: str, code: bool = False) -> int:
    """The masked message's hash, its lowest bits replaced by the message's kind; what is shown as code is grouped apart."""
    masked, tally = _read(message)
    if masked is None:
        masked = _mask_whole(message)
    return boilerplate.hash_of("\x02" + masked if code else masked) >> KIND_BITS << KIND_BITS | _kind(message, code, tally)


def message_hashes(text: str, code: bool = False) -> list[int]:
    """``message_hash`` of every message of the text."""
    return [message_hash(m, code) for m in messages(text)]


_short_message_hashes = lru_cache(maxsize=50_000)(message_hashes)


def text_evidence(text: str, code: bool = False) -> tuple[int, list[int]]:
    """What one text says without its corpus: (bits of what its messages are by the rules, hashes of those left to their groups)."""
    bits, doubtful = 0, []
    for h in message_hashes(text, code):
        kind = h & (1 << KIND_BITS) - 1
        bits |= _BITS.get(kind, 0)
        if kind in (DOUBTFUL_CONTENT, DOUBTFUL_ASIDE):
            doubtful.append(h)
    return bits, doubtful


def line_evidence(x: "boilerplate.Line") -> tuple[int, list[int]]:
    return 0, _short_message_hashes(x.text, x.code) if len(x.text) < boilerplate.SHORT else message_hashes(x.text, x.code)


EVIDENCE = "field_name string, rec_id long, source long, hashes array<long>"


def _evidence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [message_hashes(t, bool(code)) for t, code in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, pa.list_(pa.int64()))], names=[x.split()[0] for x in EVIDENCE.split(", ")])


def evidence(texts: DataFrame) -> DataFrame:
    """The messages of each text; ``texts`` has field_name, rec_id, source, text and code (whether it is shown as code)."""
    rows = texts.where("text is not null and text <> ''")
    return rows.select("field_name", "rec_id", F.xxhash64(F.coalesce("source", F.lit(""))).alias("source"), "text", "code").mapInArrow(_evidence_batches, EVIDENCE)


def snippet_texts(results: DataFrame) -> DataFrame:
    return results.select(F.lit("result.snippet").alias("field_name"), F.col("result_id").alias("rec_id"), F.col("host").alias("source"), F.col("snippet").alias("text"), F.lit(False).alias("code"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """The messages of each line of the main slots of ``pages``, but for headlines."""
    lines = boilerplate.classified_lines(pages, line_evidence)
    kept = lines.where((F.col("field_name") == "page.markdown") & ~F.col("drop") & (F.col("bits").bitwiseAND(boilerplate.TOP) == 0))
    return kept.select("field_name", F.col("page_id").alias("rec_id"), F.col("host").alias("source"), "hashes")


def residue_records(texts: DataFrame) -> DataFrame:
    """(field_name, rec_id) of the records of ``texts`` that hold residue instead of content.

    A record may have many rows, as a page has lines. Null and empty texts count for
    nothing; repeated rows change nothing; an empty table gives an empty one.
    """
    return judged_records(evidence(texts))


def notice_groups(said: DataFrame, sources: int) -> DataFrame:
    """(message) of the groups that are notices, of ``said`` (message, kind, source) of all ``sources``.

    Each source counts once for a group: for it if the rules call one of its messages a
    notice or doubtful, against it else.
    """
    telling = F.col("kind").isin(NOTICE, DOUBTFUL_CONTENT, DOUBTFUL_ASIDE)
    groups = said.groupBy("message", "source").agg(F.bool_or(telling).alias("telling")).groupBy("message").agg(F.count("*").alias("sources"), F.count_if("telling").alias("telling"))
    return groups.where((F.col("telling") >= max(WIDE_LEAST, WIDE_SHARE * sources)) & (2 * F.col("telling") > F.col("sources"))).select("message")


def judged_records(found: DataFrame) -> DataFrame:
    """``residue_records`` of a table of evidence.

    Every message is grouped, those beside content too: they can't make their own record
    residue, but show that the same message is a notice where it stands alone.
    """
    found = stored(found)
    said = found.select("field_name", "rec_id", "source", F.explode("hashes").alias("hash")).select("field_name", "rec_id", "source", F.shiftright("hash", KIND_BITS).alias("message"), F.col("hash").bitwiseAND((1 << KIND_BITS) - 1).alias("kind"))
    notices = bounded_broadcast(stored(notice_groups(said, found.select("source").distinct().count()).withColumn("wide", F.lit(True))))
    # a placeholder's kind is its own, as the mask doesn't tell how it was written
    kind, wide = F.col("kind"), F.coalesce("wide", F.lit(False)) & ~F.col("kind").isin(PLACE, UNFILLED, MENTION)
    every = said.join(notices, "message", "left").select("field_name", "rec_id", kind.isin(PLACE, UNFILLED).alias("unfilled"), ((kind == NOTICE) | wide).alias("notice"), (kind.isin(CONTENT, MENTION, DOUBTFUL_CONTENT) & ~wide).alias("content"))
    return every.groupBy("field_name", "rec_id").agg(*[F.bool_or(c).alias(c) for c in ("unfilled", "notice", "content")]).where("unfilled or (notice and not content)").select("field_name", "rec_id")
