"""Template residue, filler text, error pages and notices that scripts are needed.

Unfilled placeholders are matched by delimiter-specific grammars: each kind of delimiter (braces, brackets,
angle brackets, percent signs, hashes, at signs, format directives, capital names) has its own rule for what
may stand inside, so that ``[ISO 9001]`` or ``50% linen`` match none. Filler is measured by density: the share
of filler words in a run of words. Error pages and script notices are matched as sentences that have both a
subject (page, site, request) and a predicate (not found, blocked, needs scripts), within a few words of each other.
Texts that speak of such signs are discounted by context and density: code spans are cut out first, and a match that
is less than half of a sentence that explains or gives examples counts for nothing.

Rules are run only on texts that hold one of the strings each of their matches must hold, derived from the rules
themselves.

Defined results: null and empty fields are no cases; very long texts are scanned whole, sentence by
sentence; repeated rows give repeated marks; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import itertools
import re
from re import _casefix, _parser

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- placeholders: one grammar per delimiter --------------------------------------------------------------

NAME = r"[A-Za-z_][\w.\-]*"  # an identifier, dotted or not
WORDS = r"[A-Za-z_][\w.\- ]*"
# Nouns that templates ask to be filled in; used where the delimiter alone is too weak.
SLOT = (
    r"(?:compan(?:y|ies)|business|firm|brand|shop|store|site|page|post|blog|product|service|item|category|city|town|country|region|state|address|street|phone|"
    r"e-?mail|name|title|tagline|slogan|logo|headline|heading|description|keyword|text|content|copy|date|year|author|industry|location|url|link|image|price|number|seo\w*|meta\w*)"
)
VERB = r"(?:insert|enter|add|type|put|write|replace|your|change|edit|describe|fill(?: in)?|placeholder|todo|tbd|xxx+)"
PLACEHOLDERS = [
    r"\{\{[^{}]*(?:\}\}|$)",  # {{ name }}
    r"\{!!?[^{}]*(?:!!?\}|$)",  # {!! name !!}
    r"\{%[^{}]*(?:%\}|$)",  # {% name %}
    r"\{#[^{}]*#\}",
    r"[$#]\{" + WORDS + r"\}",  # ${name} #{name}
    r"\{\d+(?::[^{}]*)?\}",  # {0}
    r"\{[A-Za-z][a-z0-9]*(?:[_.][A-Za-z0-9_.]+|(?:[A-Z][a-z0-9]*)+)\}",  # {site_name} {siteName}
    r"\{[A-Z][A-Z0-9_]{2,}\}",  # {CITY}
    r"\{(?:[a-z]+ )?" + SLOT + r"(?: [a-z]+)?\}",
    r"\[\[[+*$~%!]?\s*" + WORDS + r"\]\]",  # [[name]] [[+name]]
    r"\[%[^\[\]]*%\]",  # [%NAME%]
    r"\[(?:[a-z]+:)?" + r"[a-z]+(?:[_.][a-z0-9_.]+)+\]",  # [site_name]
    r"\[[A-Z]+(?:_[A-Z0-9]+)+\]",
    r"\[(?:\w+ ){0,3}" + SLOT + r"(?:s|_?here| here| name)?\]",  # [City] [Your Company Name]
    r"\[" + VERB + r"\b[^\[\]]*\]",
    r"<!--\s*#?\s*[\w.: ]+-->",
    r"<%[=\-#!@]?[^<>]*(?:%>|$)",  # <%= name %>
    r"&lt;%.*?%&gt;",
    r"<\?(?:php|=)[^<>]*(?:\?>|$)",
    r"<<\s*" + WORDS + r">>",
    r"&lt;&lt;\s*" + WORDS + r"&gt;&gt;",
    r"(?:<|&lt;)(?:\w+ ){0,3}" + SLOT + r"(?: here| name)?(?:>|&gt;)",  # <Company Name>
    r"(?:<|&lt;)" + VERB + r"\b[\w ]+(?:>|&gt;)",
    r"%%\s*" + WORDS + r"%%",
    r"(?<!\d)(?<!\d )%[A-Za-z]+[_.][\w.]*%",  # %site_name%
    r"(?<!\d)(?<!\d )%[A-Z][A-Z_]{2,}%",
    r"(?<!\d)(?<!\d )%" + SLOT + r"%",
    r"(?<![\d%])(?<!\d )%(?:\d{1,2}\$)?[sd@](?![\w%])",  # %s %1$s
    r"@@\s*" + WORDS + r"@@",
    r"(?<![#\w])#{2,3}\s?" + NAME + r"\s?#{2,3}",
    r"(?<!\w)__[A-Za-z][A-Za-z0-9_.]*?__(?!\w)",
    r"(?<![\w$])\$[a-z]+[A-Z_][A-Za-z_]*\b|(?<![\w$])\$(?:title|name|city|company)\b",
    r"\b[A-Z]{3,}(?:_[A-Z0-9]+)*_(?:HERE|NAME|TITLE|CITY|TEXT|TAGLINE|DESCRIPTION|URL|ID)\b",
    r"\b(?:YOUR|INSERT|ENTER|MY|SITE|COMPANY|BUSINESS|BRAND)(?:_[A-Z]+)+\b",
    r"\((?:insert|enter|add|type|put|write|fill in)\b[^()]*\)",
    r"\bX{3,}[ _-]" + SLOT + r"\b|\b" + SLOT + r"[ _-]X{3,}\b",
    r"\b(?:YOUR|Your) (?:BUSINESS|COMPANY|SITE|BRAND|FIRM|STORE|SHOP|Business|Company|Site|Brand|Firm|Store|Shop) (?:NAME|TITLE|SLOGAN|TAGLINE|LOGO|Name|Title|Slogan|Tagline|Logo)\b",
    r"\b(?:your |the )?(?:slogan|tagline|title|company name|business name|description|headline|text|content|name|logo)(?: text)? goes here\b",
    r"^\s*(?:add|enter|insert|describe|type|write|put|edit|replace|change) (?:your|a|an|the|this)\b[^.]*?\bhere\b",
    r"\b(?:describe|introduce) your (?:business|company|firm|shop|store|products?|services?)\b[^.]*\bhere\b",
    r"\b(?:insert|enter|replace|edit) (?:this|the|your) (?:default |sample |placeholder )?(?:text|title|tagline|description|content|copy)\b",
]
# Default text of themes and builders, and values of programs that were never set.
DEFAULTS = [
    r"\bjust another [\w ]*?(?:site|blog|weblog|page|shop|store)\b",
    r"^\s*(?:hello world!?|untitled(?: (?:document|page|template|site|post|\d+))*|new (?:page|site|document|tab)(?: \d+)?|home ?page title|page title|site title|my (?:site|blog|website|store|shop|page)|default (?:title|page|description|web ?site page)|(?:page|site|title|tagline|description)(?: \d+)?(?: here)?|sample (?:page|text|title)(?: \d+)?|test(?: page| site)?(?: \d+)?|welcome to (?:nginx|apache|iis)\S*|index of /\S*)\s*$",
    r"\buntitled (?:document|page|template|site|post|block)\b",
    r"^\s*(?:undefined|null|nan|none|n/a|nil|\[object object\]|tbd|todo|xxx+|asdf+|qwerty)(?:[\s,|:/-]+(?:undefined|null|nan|none|nil))*\s*$",
    r"\[object Object\]",
    r"^\W*(?:text|test|title|description|content|xxx|abc|foo|bar|bla|blah)(?:\W+(?:text|test|title|description|content|xxx|abc|foo|bar|bla|blah)){2,}\W*$",
    r"^\W*(?:enter|add|write|provide|put|type) (?:a|an|the|your) (?:\w+ ){0,2}(?:description|title|tagline|summary|text|slogan|headline)\b",
    r"\b(?:undefined undefined|null null|nan nan)\b",
    r"\bthis is (?:the|a|an|your) (?:default|sample|example|placeholder|demo|test|first|new) (?:\w+ ){0,2}(?:description|text|title|page|post|content|site|block|tagline|store)\b",
    r"\b(?:default|placeholder|sample|dummy|example|demo|filler|test) (?:description|text|title|headline|heading|content|copy|tagline|caption|slogan)\b(?! label)(?=[\s.,;:!?\-–]*(?:$|for|to|of|in|here|goes|dummy|placeholder|sample|from|please|\d|[-–|]))",
    r"\bsample page\b.*\bsample\b|\btheme (?:block|demo|settings)\b",
    r"\bedit (?:it|this) (?:in|from|under|text|block|page)\b[^.]{0,40}(?:settings|customi[sz]er|admin|dashboard|editor)?",
    r"\b(?:site|page|domain) (?:is )?under construction\b|\bcoming soon\b\W*$|\b(?:this|the) (?:domain|site) is (?:parked|for sale)\b",
]
# Words of the customary filler text.
FILLER_WORDS = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation "
    "ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa "
    "officia deserunt mollit anim laborum fusce tempus cursus lectus vestibulum aenean semper porta pretium rutrum donec vitae ante sem quam vero mauris nunc tellus viverra feugiat "
    "phasellus orbis mundi vestra vivamus curabitur praesent pellentesque suspendisse ultrices ultricies orci turpis ligula massa augue libero justo risus purus metus lacinia dapibus tincidunt posuere".split()
)
FILLER_SURE = frozenset("lorem ipsum consectetur adipiscing eiusmod incididunt aenean vestibulum pellentesque phasellus".split())
# How each language calls filler or sample text.
FILLER_PHRASES = [
    r"(?:\bdummy text\b\W*){2,}|\bfiller text\b|\bplaceholder text\b|\bdummy (?:copy|content)\b|\btext placeholder\b|^\s*dummy text\b",
    r"\bblindtext\b|\bplatzhalter(?:text)?\b|\bmustertext\b|\bbeispieltext\b|\bfülltext\b|\bhier (?:den |ihren |einen )?(?:\w+ )?(?:text|beschreibungstext|titel|slogan|firmennamen?|namen?|beschreibung)\b[^.]{0,30}\b(?:einfügen|eingeben|einsetzen|ergänzen|hinzufügen)\b",
    r"\btexto de (?:relleno|ejemplo|muestra|prueba)\b|\b(?:escriba|escribe|inserte|introduzca|ponga|añada|pon)\b[^.]{0,20}\baquí\b|\baquí (?:va|su|tu|el) \w+|\bnombre de (?:su|la|tu) empresa\b\W*$",
    r"\btexte (?:de remplissage|d['’]exemple|fictif|factice|provisoire|de substitution)\b|\b(?:saisissez|insérez|entrez|écrivez|ajoutez|mettez)\b[^.]{0,12}\bici\b|\bfaux[- ]texte\b",
    r"\btesto (?:segnaposto|di esempio|di prova|fittizio|riempitivo|di riempimento)\b|\b(?:inserire|inserisci|inserite|scrivi|scrivete|aggiungi|digita(?:re)?)\b[^.]{0,16}\bqui\b|\bqui va (?:il|la)\b",
    r"\btexto (?:de exemplo|de preenchimento|fict[íi]cio|provis[óo]rio|de teste|modelo)\b|\b(?:insira|digite|escreva|coloque|adicione|introduza)\b[^.]{0,20}\baqui\b",
    r"\b(?:voorbeeld|opvul|vul|plaatshouder|proef|dummy)tekst\b|\bhier (?:uw|de|een|komt)\b[^.]{0,30}\b(?:invoegen|invullen|plaatsen|komt|typen|toevoegen)\b|\b(?:vul|typ|plaats|voer|zet) hier\b",
    r"\b(?:przykładowy|zastępczy|testowy) (?:tekst|tytuł|opis)\b|\btekst (?:zastępczy|przykładowy|wypełniający|testowy)\b|\btutaj (?:wpisz|wstaw|dodaj)\b|\b(?:wpisz|wstaw|dodaj|wprowadź)\b[^.]{0,12}\b(?:tutaj|tu)\b",
    r"\b(?:örnek|deneme|dolgu|yer tutucu) (?:metin|metni|başlık|açıklama|sayfa|yazı)|\bburaya\b[^.]{0,40}\b(?:girin|yazın|ekleyin|giriniz|yazınız|gelecek)\b",
    r"(?:текст[- ]?(?:заполнитель|заглушка|рыба)|заполняющий текст|(?:пример|образец|заглушка) текста|тестовый текст|примерный текст|(?:вставьте|введите|напишите|добавьте|впишите)[^.]{0,30}(?:здесь|сюда)|(?:здесь|сюда) (?:вставьте|введите|будет|напишите|добавьте))",
    r"示例文[本字]|占位(?:文本|符|文字)|填充文[本字]|样本文[本字]|示范文[本字]|测试文[本字]|此处(?:输入|填写|插入|添加)|(?:请)?在(?:此|这里)(?:处)?(?:输入|填写|插入|添加)|(?:输入|填写)(?:您|你)的(?:公司|标题)",
    r"नमूना (?:पाठ|टेक्स्ट|पृष्ठ|विवरण)|(?:डमी|भराव|प्लेसहोल्डर) (?:टेक्स्ट|पाठ)|(?:यहाँ|यहां)[^।]{0,40}(?:लिखें|डालें|जोड़ें|दर्ज करें)",
    r"نص (?:تجريبي|بديل|مؤقت|عينة|نموذجي|وهمي|مثال|افتراضي|حشو)|(?:أدخل|اكتب|ضع|أضف)[^.]{0,30}هنا|هنا (?:يكتب|يوضع|نص)",
]

# ---- errors and blocking messages ---------------------------------------------------------------------------

THING = r"(?:(?:web|start|home|landing)?(?:page|site)|document|file|link|url|resource|address|listing|directory|host|server|account|domain|website|request(?:ed url)?|content|connection|gateway|service|catalogue|access)"
GONE = (
    r"(?:not (?:be )?found|can(?:not|'t|’t|\s?not) be (?:found|reached|displayed|loaded|opened|shown|located|served)|could ?(?:not|n['’]t) be (?:found|reached|displayed|loaded|opened|located|served)|no longer (?:here|exists?|available)|"
    r"does(?: not|n['’]t) exist|is (?:gone|missing|blocked|forbidden|unavailable|unreachable|offline|down|suspended|over its)\b|(?:is|was|has been|were|been) (?:permanently |temporarily )?(?:moved|removed|deleted|suspended|disabled|blocked|denied|unavailable)|moved or removed|"
    r"took too long|timed out|needs a login|requires? (?:a )?(?:login|authentication|authori[sz]ation)|temporarily (?:unavailable|down|closed)|over its (?:traffic|bandwidth|quota)|exceeded (?:its|the)|(?:is|are) not available|refused (?:to connect|the connection)|is currently (?:unavailable|offline|down))"
)
ERRORS = [
    r"\b(?:http|https|error|err|code|status|fehler|erreur|errore|erro|hata|błąd|ошибка|错误|错误代码|خطأ|त्रुटि|fout)\b[\s:/#–-]*(?:code[\s:/#–-]*)?[45]\d\d\b",
    r"\b[45]\d\d[\s:–|-]+(?:not found|forbidden|bad gateway|service (?:temporarily )?unavailable|internal (?:server )?error|unauthori[sz]ed|gone|bad request|too many requests|gateway time-?out|error|access denied|page|fehler|erreur|errore|erro)\b",
    r"^\W*[45]\d\d\s*[:–|-]\s*(?:\w+ )*(?:error|failed|failure|fault|denied|refused|missing|unavailable)\b",
    THING + r"\s(?:you (?:asked|are looking|were looking|requested|want)(?: for)?\s)?(?:has |is |was )?(?:failed|fails|unable) to (?:render|load|open|respond|answer|display)|^\W*(?:site|page|account|request|access|connection|domain) (?:suspended|blocked|denied|removed|disabled|expired|rejected|closed)\W*$",
    r"\bnothing (?:lives|is|was|exists|to see|here)\b[^.]{0,20}\b(?:at this address|here|found)\b|\bone moment\b[^.]{0,30}\bcheck\w*|\bchecking your (?:browser|connection)\b",
    r"\b(?:internal server (?:error|fault|failure|problem)|bad gateway|gateway time-?out|service (?:temporarily )?unavailable|bad request|too many requests|request time-?out|forbidden(?! city)|permission denied|connection (?:refused|reset|timed out)|(?:database|db) (?:connection )?error|error establishing|server (?:error|fault)|origin is unreachable|proxy error)\b(?=\W*(?:$|at|from|on|in|by|edge|node|for|to|while|establishing|\(|[-–|:]|ref|code|\d))",
    r"^\W*access (?:is |was )?denied\b|\baccess (?:to (?:this|the) (?:\w+ )?" + THING + r" )?(?:is|was|has been) (?:denied|forbidden|blocked|restricted)\b|\byou (?:do not|don['’]t) have (?:permission|access)\b|\bnot (?:allowed|authori[sz]ed) to (?:access|view|see)\b",
    r"^\W*(?:error|oops|sorry|whoops|ooh|uh[- ]oh|we hit a snag|something went wrong)\b[^.]{0,60}\b" + THING + r"\b",
    r"\b(?:something went wrong|we hit a snag|an (?:unexpected )?error (?:has )?occurred|please try again later)\b",
    r"\b(?:the|this|that|your|requested)\s(?:\w+\s){0,2}?" + THING + r"(?:\s(?:you (?:asked|are looking|were looking|requested|want)(?: for)?|at this address|requested))?\s(?:\w+\s)?" + GONE,
    r"^\W*(?:page|site|file|document|resource|url|link|address|host|domain|account)\s(?:\w+\s)?" + GONE,
    r"^\W*(?:not found|page not found|forbidden|unauthori[sz]ed|nothing (?:was )?found|no such (?:page|file|site))\W*$",
    r"\b(?:fatal|parse|syntax|runtime|type|value|reference|notice|warning)\b\s?(?:error)?:?\s.{0,60}\b(?:line \d+|in [/\\]\S+|exception|undefined|uncaught|stack)\b",
    r"\b(?:uncaught|unhandled) (?:exception|error|\w*error)\b|\bundefined (?:variable|index|function|offset|method|property)\b|\bstack ?trace\b|\btraceback\b|\bnull ?pointer ?exception\b|\bsegmentation fault\b|\bout of memory\b|\bcannot (?:modify header|redeclare|connect to (?:the )?database|read propert)|\bfailed to (?:open stream|connect to|load (?:module|resource))\b|\btoo many connections\b|\bcould not connect to\b|\bSQL(?:STATE)?\b.{0,30}\b(?:error|syntax)\b|\bmysql(?:i)?_\w+\(",
    r"\b(?:your (?:ip|request|network|browser|connection)|you)\b[^.]{0,40}\b(?:has been|have been|was|were|is|are|looked)\b[^.]{0,30}\b(?:blocked|banned|denied|stopped|automated|rejected|flagged)\b|\bblocked (?:by|for) (?:our|the|your|security) ?(?:firewall|network|security|policy|server|ip)\b|\b(?:verify|checking|prove)\b[^.]{0,30}\b(?:you are (?:a )?(?:human|not a robot)|your browser|human)\b|\bcaptcha\b|\bray id\b|\bddos protection\b",
    r"\b(?:this|the|your) (?:account|site|domain|website|page) (?:has been|is|was) (?:suspended|disabled|closed|expired|deactivated)\b",
    r"\b(?:rate|request|usage|traffic) limit (?:reached|exceeded|hit)\b|\bretry (?:after|in) \d+|\b(?:verifying|verify|confirm|checking) (?:that|if|whether) you(?: are|['’]re) (?:a )?(?:human|not)|\bunusual traffic\b|\bplease (?:wait|try again)\b[^.]{0,40}\b(?:check|verif|later)\w*",
    r"\bstart page of\b.{0,60}$(?<=\.)|^\W*(?:return|go back|back) to (?:the )?(?:start|home) ?page\b",
    # other languages: subject and predicate
    r"\b(?:seite|datei|adresse|dokument|url|link|inhalt|server|dienst)\b[^.]{0,60}\b(?:nicht gefunden|nicht verfügbar|existiert nicht|nicht vorhanden|nicht erreichbar|wurde (?:verschoben|gelöscht|entfernt|gesperrt)|gesperrt|konnte nicht)\b|\bzugriff (?:verweigert|gesperrt)\b|\binterner (?:server)?fehler\b|\bserverfehler\b",
    r"\b(?:página|pagina|archivo|sitio|dirección|documento|enlace|servidor|servicio)\b[^.]{0,60}\b(?:no (?:encontrad[oa]|existe|disponible|se (?:ha )?(?:encontr\w+|puede)|está disponible|pudo)|ha sido (?:eliminad|movid|suspendid)\w+|fue (?:eliminad|movid)\w+)|\bacceso (?:denegado|prohibido)\b|\berror (?:interno )?del servidor\b|\bno (?:se )?(?:encontr|pud)\w+ la página\b",
    r"\b(?:page|fichier|adresse|document|site|lien|ressource|serveur|service)\b[^.]{0,60}\b(?:introuvable|n['’]existe (?:pas|plus)|non trouvée?|n['’]a pas (?:été|pu)|indisponible|a été (?:déplacée?|supprimée?|suspendu)|inaccessible)\b|\baccès (?:refusé|interdit)\b|\berreur (?:interne )?(?:du )?serveur\b",
    r"\b(?:pagina|file|documento|sito|indirizzo|risorsa|server|servizio)\b[^.]{0,60}\b(?:non (?:trovat[oa]|esiste|disponibile|è (?:stat[oa] trovat|disponibil)\w*)|è stat[oa] (?:spostat|rimoss|eliminat|sospes)\w+|inesistente|irraggiungibile)\b|\baccesso (?:negato|vietato)\b|\berrore (?:interno )?del server\b",
    r"\b(?:página|arquivo|site|documento|endereço|recurso|servidor|serviço)\b[^.]{0,60}\b(?:não (?:encontrad[oa]|existe|disponível|foi (?:encontrad|possível)\w*|pôde|está disponível)|foi (?:removid|movid|suspens)\w+|indisponível)|\bacesso (?:negado|proibido)\b|\berro (?:interno )?do servidor\b",
    r"\b(?:pagina|bestand|site|document|adres|server|dienst)\b[^.]{0,60}\b(?:niet gevonden|bestaat niet|niet beschikbaar|niet (?:worden )?(?:gevonden|geladen)|kan niet|is (?:verplaatst|verwijderd|geblokkeerd)|onbereikbaar|kon niet)\b|\btoegang (?:geweigerd|verboden)\b|\b(?:interne )?serverfout\b",
    r"\b(?:stron[aęy]|plik\w*|adres\w*|dokument\w*|serwis\w*|zasob\w*|serwer\w*)\b[^.]{0,60}(?:nie (?:została? )?(?:znalezion|istniej|odnalezion|można|jest dostępn|odpowiad)\w*|została? (?:przeniesion|usunięt|zablokowan)\w+|niedostępn\w+)|\bnie (?:znaleziono|odnaleziono) (?:strony|pliku|zasobu)|\b(?:odmowa dostępu|dostęp (?:zabroniony|zablokowany))|\b(?:wewnętrzny )?błąd serwera\b",
    r"\b(?:sayfa|dosya|site|adres|belge|sunucu|bağlantı|içerik)\w*\b[^.]{0,60}(?:bulunamadı|bulunmuyor|mevcut değil|kaldırıl\w+|taşın\w+|ulaşılamıyor|engellen\w+|açılamadı|yüklenemedi)|\berişim (?:engellendi|reddedildi|yasak)|\b(?:iç )?sunucu hatası\b",
    r"(?:страниц|файл|документ|сайт|ресурс|адрес|сервер|сервис)\w*[^.]{0,60}(?:не (?:найден|существу|доступ|удалось|отвеча)\w*|удал[её]н\w*|перемещ[её]н\w*|недоступ\w+|заблокирован\w*)|(?:доступ (?:запрещ[её]н|закрыт|заблокирован)|(?:внутренняя )?ошибка сервера)",
    r"(?:页面|网页|文件|地址|网站|链接|资源|服务器|服务)[^。]{0,25}(?:不存在|未找到|无法(?:找到|访问|显示|打开|连接)|找不到|已(?:被)?(?:删除|移动|移除|停用|封禁)|不可用|出错|错误)|找不到[^。]{0,10}(?:页面|网页|文件|资源)|未找到[^。]{0,10}(?:页面|网页)|(?:拒绝访问|访问被拒绝|禁止访问|服务器(?:内部)?错误|内部服务器错误)",
    r"(?:पृष्ठ|पेज|फ़ाइल|फाइल|साइट|पता|दस्तावेज़?|सर्वर)[^।]{0,40}(?:नहीं मिल\w*|मौजूद नहीं|उपलब्ध नहीं|हटा|अवरुद्ध|नहीं खुल)|(?:पहुँच|प्रवेश|एक्सेस) (?:अस्वीकृत|निषिद्ध|वर्जित)|सर्वर (?:त्रुटि|में त्रुटि)|आंतरिक (?:सर्वर )?त्रुटि",
    r"(?:الصفحة|صفحة|الملف|الموقع|العنوان|الرابط|الخادم|المستند)[^.]{0,50}(?:غير موجود|لم يتم العثور|لا يمكن|غير متاح|تم (?:نقل|حذف|حظر|إيقاف)|محظور|غير متوفر|تعذر)|لم يتم العثور على (?:ال)?صفحة|(?:تم )?رفض الوصول|الوصول (?:مرفوض|ممنوع|محظور)|خطأ (?:داخلي )?في الخادم",
]

# ---- notices that scripts are needed ------------------------------------------------------------------------

SCRIPT = r"(?:java ?script|\bjs\b|(?:client[- ]side )?(?:scripting|scripts?)\b|client[- ]side rendering)"
NOTICES = [
    r"\bnoscript\b",
    r"\b(?:enable|activate|turn(?:ing)? on|switch on|allow|permit)\b[^.]{0,25}" + SCRIPT,
    SCRIPT + r"[^.]{0,40}\b(?:is |are |be |must be |to be |being )?(?:on\b|disabled|turned off|switched off|turned on|enabled|deactivated|blocked|off|required|needed|not (?:enabled|available|supported|running|allowed))\b",
    r"\b(?:needs?|requires?|relies on|depends on|must have)\b[^.]{0,25}" + SCRIPT,
    r"\b(?:without|unless)\b[^.]{0,25}" + SCRIPT,
    r"\bbrowser\b[^.]{0,40}\b(?:does not|doesn['’]t|cannot|not|blocks?|has|with)\b[^.]{0,25}" + SCRIPT,
    r"\b(?:built|made|works only|designed|meant|intended|made only)\b[^.]{0,12}\b(?:for|in|with)\b[^.]{0,12}\bbrowsers?\b[^.]{0,20}" + SCRIPT,
    r"\bbrowser (?:is )?(?:not|un)[ -]?supported\b|\b(?:your|this) browser (?:is|does not|doesn['’]t|cannot)\b",
    r"\b(?:cookies|(?:java ?)?scripts?)\b[^.]{0,40}\bmust be (?:allowed|enabled|accepted|permitted|activated|turned on|switched on)\b",
    r"\bchange your browser settings\b|\bplease (?:enable|allow|accept) cookies\b|\bcookies (?:must be|are) (?:enabled|required|disabled)\b",
    r"(?:java ?script|\bskript\w*|\bscripts?\b)[^.]{0,50}(?:aktivier|einschalt|erforderlich|benötig|deaktiviert|erlauben|zulassen|ausgeschaltet)|(?:aktivier|benötig|einschalt|erlaub|erforder|brauch)\w*[^.]{0,40}(?:java ?script|\bskript\w*|\bscripts?\b)|\bschalt\w*[^.]{0,40}(?:java ?script|\bskript\w*|\bscripts?\b)[^.]{0,20}\bein\b",
    r"(?:java ?script|\bscripts?\b|secuencias de comandos)[^.]{0,40}(?:activ|habilit|desactivad|deshabilitad|necesari|requerid)|(?:activ[ea]|habilit|permit|necesit|requier)\w*[^.]{0,40}(?:java ?script|\bscripts?\b)",
    r"(?:java ?script|\bscripts?\b)[^.]{0,40}(?:activ|autoris|désactivé|nécessaire|requis)|(?:activez|activer|autoris|nécessit|requiert|exige|besoin)\w*[^.]{0,40}(?:java ?script|\bscripts?\b)",
    r"(?:java ?script|\bscript\b|gli script)[^.]{0,40}(?:attiv|abilit|disattivat|disabilitat|necessari|richiest)|(?:attiv|abilit|richied|necessit|consent)\w*[^.]{0,40}(?:java ?script|\bscript\b)",
    r"(?:java ?script|\bscripts?\b)[^.]{0,40}(?:ativ|habilit|desativad|desabilitad|necessári)|(?:ativ|habilit|permit|requer|precis|necessit|exige)\w*[^.]{0,40}(?:java ?script|\bscripts?\b)",
    r"(?:java ?script|\bscripts?\b)[^.]{0,40}(?:inschakel|aanzet|ingeschakeld|uitgeschakeld|vereist|nodig|toestaan|staat uit)|(?:schakel|zet|vereist|activeer|sta)\w*[^.]{0,40}(?:java ?script|\bscripts?\b)[^.]{0,20}(?:\bin\b|\baan\b|toe\b|$)",
    r"(?:java ?script\w*|\bskrypt\w*)[^.]{0,40}(?:włącz|wymagan|wyłączon|obsługi|aktyw|zezw)|(?:włącz|wymaga|zezw|obsług|aktyw)\w*[^.]{0,40}(?:java ?script|skrypt)",
    r"(?:java ?script|\bbetik\w*|komut dosya\w*|\bscript)\w*[^.]{0,40}(?:etkinleştir|açık|açın|açınız|gerek|kapalı|devre dışı|izin)|(?:etkinleştir|izin ver)\w*[^.]{0,30}(?:java ?script|betik)",
    r"(?:java ?script|скрипт|сценари)\w*[^.]{0,40}(?:включ|отключ|необходим|требу|разреш|выключ|поддерж)|(?:включ|необходим|требу|разреш|отключ|поддерж)\w*[^.]{0,40}(?:java ?script|скрипт|сценари)",
    r"(?:启用|开启|打开|需要|允许|不支持|禁用|关闭)[^。]{0,12}(?:java ?script|脚本)|(?:java ?script|脚本)[^。]{0,12}(?:启用|开启|打开|已禁用|被禁用|关闭|才能|支持|功能)",
    r"(?:java ?script|जावास्क्रिप्ट|स्क्रिप्ट)[^।]{0,40}(?:चालू|सक्षम|सक्रिय|अक्षम|बंद|आवश्यक|ज़?रूर|अनुमति)|(?:सक्षम|चालू|सक्रिय)[^।]{0,30}(?:java ?script|स्क्रिप्ट)",
    r"(?:java ?script|جافا ?سكر[يب]+ت|البرامج النصية|النصوص البرمجية|السكربت)[^.]{0,40}(?:تفعيل|تشغيل|تمكين|معطل|مطلوب|معطلة|مفعل)|(?:تفعيل|تشغيل|تمكين|فعّ?ل|يتطلب|يرجى)[^.]{0,40}(?:java ?script|جافا|البرامج النصية|النصوص البرمجية|السكربت)",
]
CODE = re.compile(r"```.*?```|`[^`\n]+`|<code>.*?</code>", re.S | re.I)
#: What stands around signs and messages that a text speaks of and doesn't hold.
TUTORIAL = re.compile(r"\b(?:e\.g\.|for example|such as|for instance|the syntax|tutorials?|snippets?|how to (?:fix|write|use)|template (?:engines?|variables?|tags?)|in (?:jinja|django|php|twig|handlebars|templates?))(?!\w)", re.I)
#: A match that is less than this share of its sentence is discounted where the sentence speaks of such signs.
DENSE = 0.5
SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？।؟])\s*|\n+|\s[|»•·/]\s|\s[–—-]\s|:\s")
WHOLE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？।؟])\s*|\n+")
WORD = re.compile(r"[^\W\d_]+")


def _any(patterns: list[str], flags: int = re.I) -> re.Pattern:
    return re.compile("|".join(f"(?:{p})" for p in patterns), flags)


# Case decides in a few placeholder grammars (capital names), so those keep it.
_CASED = [p for p in PLACEHOLDERS if "[A-Z]" in p or "YOUR" in p]
PLACEHOLDER = _any([p for p in PLACEHOLDERS if p not in _CASED])
PLACEHOLDER_CASED = _any(_CASED, 0)
DEFAULT = _any(DEFAULTS)
PHRASE = _any(FILLER_PHRASES)
ERROR = _any(ERRORS)
NOTICE = _any(NOTICES)


# ---- what every match of a rule must hold, to leave most sentences out without running the rules -------------

# Letters that match one another where case is ignored, though lower case keeps them apart (dotless i, long s), as one of them.
_ALIKE = {ord(x): chr(min(c, *others)) for c, others in _casefix._EXTRA_CASES.items() for x in map(chr, (c, *others))} | {0x130: "i"}
_UNLIKE = re.compile("[" + "".join(map(chr, _ALIKE)) + "]")


def folded(text: str) -> str:
    """``text`` in lower case, with letters that match one another where case is ignored written alike."""
    if text.isascii():
        return text.lower()
    low = text.replace("\u0130", "i").lower()
    return low.translate(_ALIKE) if _UNLIKE.search(low) else low


def _least(strings: set[str]) -> set[str]:
    """``strings`` without those that hold another."""
    return {s for s in strings if not any(o != s and o in s for o in strings)}


def _exact(op, arg) -> set[str] | None:
    """All strings a part of a rule matches, where they are few."""
    if op is _parser.LITERAL:
        return {folded(chr(arg))}
    if op in (_parser.AT, _parser.ASSERT, _parser.ASSERT_NOT):
        return {""}
    if op is _parser.IN and len(arg) <= 4 and all(o is _parser.LITERAL for o, _ in arg):
        return {folded(chr(c)) for _, c in arg}
    if op is _parser.SUBPATTERN:
        return _exact_all(arg[3])
    if op is _parser.BRANCH:
        each = [_exact_all(x) for x in arg[1]]
        return set().union(*each) if None not in each else None
    if op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and arg[1] in (1, 2):
        once = _exact_all(arg[2])
        if once is not None:
            return set().union(*[{"".join(x) for x in itertools.product(once, repeat=n)} for n in range(arg[0], arg[1] + 1)])
    return None


def _exact_all(parts) -> set[str] | None:
    out = {""}
    for op, arg in parts:
        one = _exact(op, arg)
        if one is None or len(one) * len(out) > 64:
            return None
        out = {x + y for x in out for y in one}
    return out


def needed(parts) -> set[str] | None:
    """Strings of which every match of a parsed rule holds one; None where there are none."""
    choices, run = [], {""}
    for op, arg in [*parts, (None, None)]:
        one = None if op is None else _exact(op, arg)
        if one is not None and len(one) * len(run) <= 64:
            run = {x + y for x in run for y in one}
            continue
        choices.append(_least(run))
        run = one or {""}
        if one is not None or op is None:
            continue
        if op is _parser.SUBPATTERN:
            choices.append(needed(arg[3]))
        elif op is _parser.BRANCH:
            each = [needed(x) for x in arg[1]]
            choices.append(_least(set().union(*each)) if None not in each else None)
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and arg[0] > 0:
            once = _exact_all(arg[2])
            choices.append({"".join(x) for x in itertools.product(once, repeat=arg[0])} if once and arg[0] < 4 and len(once) < 5 else needed(arg[2]))
    choices = [c for c in choices if c and "" not in c]
    # the longest strings leave out most, signs more than letters
    return max(choices, key=lambda c: (min(len(x.strip()) + 3 * (not x.replace(" ", "a").isalnum()) for x in c), -len(c)), default=None)


def _cues(patterns: list[str]) -> list[str]:
    each = [needed(_parser.parse(p, re.I)) for p in patterns]
    return sorted(_least(set().union(*each)), key=lambda x: (len(x), x)) if None not in each else [""]


_CUES = {"placeholder": _cues(PLACEHOLDERS), "phrase": _cues(FILLER_PHRASES), "default": _cues(DEFAULTS), "notice": _cues(NOTICES), "error": _cues(ERRORS)}


def filler_density(text: str) -> bool:
    """Whether a run of at least three words is mostly filler words, with a sure one or nothing else in it."""
    words = [w.lower() for w in WORD.findall(text)]
    if len(words) < 3:
        return len(words) == 2 and set(words) <= FILLER_WORDS and bool(set(words) & FILLER_SURE)
    hits = [w in FILLER_WORDS for w in words]
    total = sum(hits)
    if total < 3:
        return False
    if total >= 0.6 * len(words):
        return True
    best = run = 0
    for h in hits:
        run = run + 1 if h else 0
        best = max(best, run)
    return best >= 5 or best >= 3 and bool(set(words) & FILLER_SURE)


def _automaton() -> ahocorasick.Automaton:
    """All strings of all rules at once, each with the rules it is of."""
    rules: dict[str, set[str]] = {}
    for rule, cues in _CUES.items():
        for c in cues:
            rules.setdefault(c, set()).add(rule)
    out = ahocorasick.Automaton()
    for c, of in rules.items():
        out.add_word(c, frozenset(of))
    out.make_automaton()
    return out


_ALWAYS = frozenset(rule for rule, cues in _CUES.items() if cues == [""])
_AUTOMATON = _automaton()


def cued(low: str) -> set[str]:
    """The rules that can match a text (folded)."""
    return _ALWAYS.union(*{of for _, of in _AUTOMATON.iter(low)})


def spoken_of(text: str, start: int, end: int) -> bool:
    """Whether what ``text`` has from ``start`` to ``end`` is a small part of a sentence that speaks of such signs."""
    first = max((m.end() for m in WHOLE.finditer(text, 0, start)), default=0)
    after = WHOLE.search(text, end)
    sentence = text[first : after.start() if after else len(text)]
    return end - start < DENSE * len(sentence.strip()) and bool(TUTORIAL.search(text[first:start]) or TUTORIAL.search(text[end : first + len(sentence)]))


def residue_kind(text: str | None) -> str | None:
    """placeholder, filler, default, error or script; None for text that describes a firm."""
    if not text or not text.strip():
        return None
    bare = CODE.sub(" ", text) if "`" in text or "<" in text else text
    low = folded(bare)
    rules = cued(low)
    filler = not FILLER_WORDS.isdisjoint(WORD.findall(low))
    if not rules and not filler:
        return None
    speaks = bool(TUTORIAL.search(bare))
    if "placeholder" in rules:
        for p in (PLACEHOLDER, PLACEHOLDER_CASED):
            for m in p.finditer(bare):
                if not (speaks and spoken_of(bare, m.start(), m.end())):
                    return "placeholder"
    if "phrase" in rules and PHRASE.search(bare):
        return "filler"
    default = "default" in rules
    if default or filler:
        for s in [bare, *SENTENCE.split(bare)]:
            if not s or not s.strip():
                continue
            if filler and filler_density(s):
                return "filler"
            if default and DEFAULT.search(s.strip()):
                return "default"
    if "notice" in rules or "error" in rules:
        for s in WHOLE.split(bare):
            own = cued(folded(s))
            n, e = "notice" in own, "error" in own
            if not (n or e):
                continue
            for x in [s, *SENTENCE.split(s)]:
                for kind, rule in (("script", NOTICE if n else None), ("error", ERROR if e else None)):
                    m = rule.search(x.strip()) if rule else None
                    if m and not (speaks and TUTORIAL.search(s) and m.end() - m.start() < DENSE * len(s)):
                        return kind
    return None


@F.pandas_udf(T.StringType())
def _kind(texts: pd.Series) -> pd.Series:
    known: dict[str | None, str | None] = {}
    out = []
    for t in texts:
        if t not in known:
            known[t] = residue_kind(t)
        out.append(known[t])
    return pd.Series(out, dtype=object)


def with_residue(df: DataFrame, column: str, name: str = "residue") -> DataFrame:
    """``df`` with the kind of residue in ``column``, null for text of a firm."""
    return df.withColumn(name, _kind(F.col(column)))


def field_texts(metadata: DataFrame, key: str = "domain", fields: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """``key``, ``field``, ``text``: the distinct non-empty texts, which repeated fetches share."""
    parts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("p")
    return metadata.select(F.col(key), parts).select(key, "p.field", "p.text").filter("text is not null and trim(text) <> ''").distinct()


def residue_fields(metadata: DataFrame) -> DataFrame:
    """``domain``, ``field``, ``residue`` of each field that holds residue."""
    return with_residue(field_texts(metadata), "text").filter("residue is not null").select("domain", "field", "residue").distinct()
