"""Patterns of the built-in gates and miners.

They are written for a reader in which ``\\b``, ``\\w`` and ``\\s`` know all alphabets; ``ready``
makes Java read them so. Group 1 captures where something is captured.
"""

from __future__ import annotations

from collections.abc import Iterable

# Results of the gates and miners depend on these very patterns, words and labels.
#: Who looks for a casino platform.
CASINO = (
    r"\bcasino\b",
    r"\bказин[оуіа]\b",
    r"\bигровой\s+клуб\b",
    r"\bigaming\b",
    r"\bi[-\s]gaming\b",
    r"\bgambling\b",
    r"\bгемблинг\w*\b",
    r"\bгамблинг\w*\b",
    r"\bбукмекер\w*\b",
    r"\bbookmaker\w*\b",
    r"\bbetting\b",
    r"\bбеттинг\w*\b",
    r"\bwhite.?label\b",
    r"\bплатформ\w+.{0,40}(казин|igaming|gambling|беттинг)\w*",
    r"\b(казин|igaming|gambling|беттинг)\w*.{0,40}платформ\w+",
    r"\bplatform\w*.{0,40}(casino|igaming|gambling|betting)\w*",
    r"\b(casino|igaming|gambling|betting)\w*.{0,40}platform\w*",
    r"\bоткрыт\w+\s+казин\w*\b",
    r"\bзапуст\w+\s+казин\w*\b",
    r"\bзапуст\w+\s+(казино|iGaming|gambling)\b",
    r"\blaunch\w*\s+casino\b",
    r"\bopen\w*\s+casino\b",
    r"\bрозгорнут\w+\s+казин\w*\b",
    r"\bсделать\s+казин\w*\b",
    r"\bсоздат\w+\s+казин\w*\b",
    r"\bcasino\s+software\b",
    r"\bigaming\s+software\b",
    r"\bcasino\s+solution\w*\b",
    r"\bgame.?provider\w*\b",
    r"\bпровайдер.{0,10}игр\w*\b",
    r"\bпровайдер.{0,10}контент\w*\b",
    r"\bсофт.{0,15}казин\w*\b",
    r"\bказин\w*.{0,15}софт\b",
    r"\bлиценз\w+.{0,20}(казин|igaming|gambling)\w*\b",
    r"\b(казин|igaming|gambling)\w*.{0,20}лиценз\w+\b",
    r"\bcasino\s+licen[sc]e\b",
)
#: Who looks for a bank account.
ACCOUNTS = (
    r"\bEMI\b",
    r"payment\s+institution",
    r"финансовая\s+инфраструктур\w+",
    r"banking\s+(?:solution|infrastructure|setup|partner|rails)",
    r"банковское\s+решение",
    r"банківське\s+рішення",
    r"финансовое\s+решение",
    r"merchant\s+(?:bank\s+)?account",
    r"merchant\s+banking",
    r"открытие\s+(?:корпоративного\s+)?счёт\w+",
    r"открытие\s+(?:корпоративного\s+)?счет\w+",
    r"відкриття\s+рахунк\w+",
    r"открыть\s+компани\w+",
    r"регистрация\s+компани\w+",
    r"company\s+(?:formation|registration|setup|incorporation)",
    r"open\s+(?:a\s+)?(?:company|entity)",
    r"\bVASP\b",
    r"igaming\s+(?:operator|project|platform|company|license)",
    r"crypto\s+(?:exchange|gateway|company|license|startup)",
    r"gambling\s+(?:license|operator|company)",
    r"betting\s+(?:company|operator|platform)",
    r"\blicens\w+\b.{0,30}\b(?:crypto|igaming|gambling|payment|emi)\b",
    r"\b(?:crypto|igaming|gambling|payment|emi)\b.{0,30}\blicens\w+\b",
    r"лицензи\w+.{0,30}(?:крипто|игейминг|платёжн)",
    r"(?:malta|кипр|cyprus|estoni\w+|latvia|lithu\w+)\b.{0,50}\b(?:company|account|license|бизнес|компани)",
    r"\bCFO\b",
    r"\btreasur\w+\b",
    r"финансовый\s+директор",
    r"фінтех\s+ліцензі\w+",
    r"fintech\s+licens\w+",
    r"нужна\s+платёж\w+",
    r"нужно\s+(?:финансовое|банковское)\s+решение",
    r"ищем\s+(?:финансовое|банковское)\s+решение",
    r"\bIBAN\b",
    r"расчётн\w+\s+счёт",
    r"расчетн\w+\s+счет",
    r"открыть\s+счёт",
    r"открыть\s+счет",
    r"нужен\s+счёт",
    r"нужен\s+счет",
    r"ищем\s+счёт",
    r"ищем\s+счет",
    r"банковский\s+счёт",
    r"банковский\s+счет",
    r"корпоративный\s+счёт",
    r"корпоративный\s+счет",
    r"нужен\s+банк\b",
    r"нужны\s+реквизиты",
    r"нужен\s+провайдер\s+для\s+расчёт",
    r"нужен\s+провайдер\s+для\s+расчет",
    r"мультивалютный\s+счёт",
    r"мультивалютный\s+счет",
    r"business\s+account",
    r"corporate\s+account",
    r"settlement\s+account",
    r"bank\s+account",
    r"open\s+(?:a\s+)?(?:business\s+|corporate\s+)?account",
    r"need\s+(?:a\s+)?(?:bank|banking|iban)",
    r"looking\s+for\s+(?:a\s+)?bank",
    r"banking\s+(?:provider|solution|partner)",
    r"\bSEPA\b",
    r"\bSWIFT\b",
    r"sepa\s+счёт",
    r"sepa\s+счет",
    r"uk\s+счёт",
    r"uk\s+счет",
    r"gbp\s+счёт",
    r"gbp\s+счет",
    r"принимать\s+sepa",
    r"получать\s+swift",
    r"receive\s+(?:via\s+)?sepa",
    r"receive\s+(?:via\s+)?swift",
    r"wire\s+transfer",
    r"payment\s+rails",
    r"\bon[\s-]?ramp\b",
    r"\boff[\s-]?ramp\b",
    r"крипто\s+в\s+фиат",
    r"вывод\s+usdt",
    r"вывод\s+крипт\w*",
    r"зачисление\s+с\s+биржи",
    r"crypto\s+to\s+fiat",
    r"usdt\s+(?:to|в)\s+(?:eur|gbp|usd)",
    r"wise\s+заблокировал",
    r"revolut\s+закрыл",
    r"заблокировали\s+счёт",
    r"заблокировали\s+счет",
    r"заморозили\s+счёт",
    r"заморозили\s+счет",
    r"замораживают\s+транзакц\w*",
    r"блокируют\s+счёт",
    r"блокируют\s+счет",
    r"альтернатива\s+revolut",
    r"альтернатива\s+wise",
    r"wise\s+(?:blocked|banned|закрыл)",
    r"revolut\s+(?:closed|banned|закрыл)",
    r"account\s+(?:blocked|frozen|terminated|closed)",
    r"alternative\s+to\s+(?:revolut|wise)",
)
#: What ends the search for an account at once.
NOT_ACCOUNTS = (
    r"\bWTB\b",
    r"куплю\s+(?:расчетн|счет|ип|ооо)",
    r"покупаю\s+(?:счет|аккаунт)",
    r"продаю\s+(?:счет|аккаунт|iban)",
    r"набираем\s+анкет",
    r"нужны\s+дроп",
    r"ищу\s+дроп",
    r"\bRUB\b",
    r"\bруб\b",
    r"залью\s+рф",
    r"поток\s+рф",
    r"реквизиты\s+рф",
    r"\bqiwi\b",
    r"\bF2F\b",
    r"face[\s-]?to[\s-]?face",
    r"личная\s+встреч",
    "наличными",
    r"\bcash\b",
    r"\bINR\b",
    r"\bUPI\b",
    r"indian\s+(?:bank|account)",
    r"\bindus\b",
    r"\bbandhan\b",
    r"\bIDBI\b",
    r"iban\s+database",
    r"база\s+(?:iban|счетов|реквизит)",
)
#: Who processes payments.
PROCESSORS = (
    r"платежн\w* провайдер",
    "payment provider",
    r"\bPSP\b",
    r"процессинг\w*",
    r"эквайр\w*",
    "acquire[rd]?",
    r"работаю по\b",
    r"покрыт\w+ по\b",
    r"cover\w*\s+(by|in)\b",
    r"работаем с\b",
    r"\bапрув\w*\b",
    r"\bapprove\s*rate\b",
    r"\bроутинг\b",
    r"\brouting\b",
    r"\bкаскад\w*\b",
    r"\bchargeback\b",
    r"\bчарджбек\b",
    r"\bмерчант\b",
    r"\bmerchant\b",
    r"\bМСС\b",
    r"\bMCC\b",
    r"\bвыплат\w*\b.*транзакц\w*",
    r"транзакц\w*.*\bвыплат\w*\b",
    r"подключ\w+\s+(к|вас|вам|магазин|мерчант)",
    r"интегрируем\w*",
    r"можем\s+подключить",
    r"предлагаем\s+(шлюз|эквайринг|процессинг)",
)
#: Who buys coins.
COINS = (
    r"куп[лию]\w*\b",
    r"покупа\w+\b",
    r"покупк\w+\b",
    r"ищ[ую]\s+(?:продавц\w+|поставщик\w+)",
    r"нужн\w+\s+(?:usdt|btc|eth|крипт\w*)",
    r"требу[ею]тся\b",
    r"need\b",
    r"needed\b",
    r"in\s+need\s+of\b",
    r"we\s+need\b",
    r"looking\s+(?:for|to\s+buy)\b",
    r"want(?:ed)?\s+to\s+buy\b",
    r"wtb\b",
    r"buy(?:ing)?\b",
    r"purchas\w+\b",
    r"sourcing\b",
    r"in\s+search\s+of\b",
    r"seeking\b",
    r"who\s+(?:can\s+)?(?:sell|supply)\b",
    r"kto\s+prodast\b",
    r"every\s+day\b",
    r"ежедневно\b",
    r"дaily\s+volume\b",
    r"long.?term\s+partner\w*\b",
    r"долгосрочн\w+\s+партн[её]р\w*\b",
    r"regular\s+supply\b",
    r"постоянн\w+\s+поставк\w*\b",
    r"company\b",
    r"компани[яию]\b",
    r"компанії\b",
    r"upfront\b",
    r"exchanger\b",
    r"supplier\b",
    r"requires?\b",
    r"high\s+volume\b",
    r"daily\s+volume\b",
    r"gaming\s+company\b",
    r"game\s+funds\b",
    r"куп\w+.{0,30}\b(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc|dai|busd)\b",
    r"(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc|dai|busd)\b.{0,30}\bкуп\w+",
    r"(?:buy|buying|need|wtb)\b.{0,30}\b(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc|dai|busd)\b",
    r"(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc|dai|busd)\b.{0,30}\b(?:available|jus\s+lmk|hmu|dm\s+me)\b",
    r"usdt\b",
    r"usdc\b",
    r"btc\b",
    r"eth\b",
    r"trx\b",
    r"ton\b",
    r"sol\b",
    r"bnb\b",
    r"xrp\b",
    r"ada\b",
    r"doge\b",
    r"near\b",
    r"arb\b",
    r"op\b",
    r"pol\b",
    r"link\b",
    r"dai\b",
    r"tether\b",
    r"bitcoin\b",
    r"ethereum\b",
    r"tron\b",
    r"solana\b",
    r"биток\b",
    r"биткоин\b",
    r"эфир\b",
    r"тезер\b",
    r"юсдт\b",
    r"тон\b",
    r"ефір\b",
    r"крипта\b",
    r"криптовалюта\b",
    r"crypto\b",
    r"cryptocurrency\b",
    r"coin\b",
    r"coins\b",
    r"token\b",
    r"tokens\b",
    r"otc\b",
    r"p2p\b",
    r"мерчант\b",
    r"merchant\b",
    r"бинанс\b",
    r"binance\b",
    r"bybit\b",
    r"okx\b",
    r"kucoin\b",
    r"trc20\b",
    r"bep20\b",
    r"\d+(?:[.,]\d+)?\s*(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc)\b",
    r"(?:usdt|btc|eth|trx|ton|sol|bnb|xmr|ltc|doge|usdc)\s*\d+(?:[.,]\d+)?\b",
)
#: Who buys coins for private use.
NOT_COINS = (
    r"лично\b",
    r"личн\w+\s+встреч\w*\b",
    r"встрет\w+\s+лично\b",
    r"для\s+себя\b",
    r"себе\s+нужен\b",
    r"себе\s+нужн\w+\b",
    r"разов\w+\b",
    r"один\s+раз\b",
    r"однораз\w+\b",
    r"небольш\w+\s+сумм\w*\b",
    r"небольш\w+\s+объ[её]м\w*\b",
    r"чуть-чуть\b",
    r"немного\s+нужно\b",
    r"personally\b",
    r"in\s+person\b",
    r"for\s+myself\b",
    r"just\s+for\s+me\b",
    r"one[-\s]time\b",
    r"small\s+amount\b",
    r"just\s+a\s+little\b",
    r"private\s+individual\b",
    r"частное\s+лицо\b",
    r"наличные\b",
    r"наличных\b",
    r"наличкой\b",
    r"нал\b",
    r"кэш\b",
    r"cash\b",
    r"cash\s+payment\b",
    r"cash\s+deal\b",
    r"за\s+наличные\b",
    r"оплата\s+наличными\b",
    r"оплачу\s+наличными\b",
    r"встреча\s+для\s+наличных\b",
    r"обмен\s+налич\w*\b",
    r"курьер\b",
    r"courier\b",
    r"офлайн\b",
    r"offline\b",
)
#: Words that block a buyer unless a glossary term redeems them.
BUYER_STOP = (
    "арбитраж", "медиабай", "медиа-байер", "байер", "вебмастер", "#buying", "media buy", "cpl", "cpm", "revshare",
    "ревшар", "rev share", "креатив", "лендинг", "прелендинг", "антидетект", "клоак", "in-app", "tiktok",
    "google ads", "fb ads", "facebook ads", "реклы", "реклов", "рекламодател", "нутра", "дейтинг", "обнал",
    "vcc-букинг", "залью", "хайчек", "бт пдф", "бт без чека", "бт чеки", "bt pdf", "pdf",
)
#: (label, pattern around {term}, capturing the definition); tried in this order.
DEFINITIONS = (
    ("em_dash_tse", r"\b{term}\b\s*[—\-–]\s*це\s+([^.\n]{{4,140}})"),
    ("tse", r"\b{term}\b\s+це\s+([^.\n]{{4,140}})"),
    ("tobto", r"\b{term}\b\s*,?\s*тобто\s+([^.\n]{{4,140}})"),
    ("oznachaie", r"\b{term}\b\s+означає\s+([^.\n]{{4,140}})"),
    ("pid_maiу", r"під\s+{term}\b\s+маю\s+на\s+увазі\s+([^.\n]{{4,140}})"),
    ("rozshyfr", r"\b{term}\b\s+розшифровується\s+як\s+([^.\n]{{4,140}})"),
    ("en_means", r"\b{term}\b\s+means\s+([^.\n]{{4,140}})"),
    ("en_stands_for", r"\b{term}\b\s+stands\s+for\s+([^.\n]{{4,140}})"),
    ("en_is", r"\b{term}\b\s+is\s+(?:a\s+|an\s+|the\s+)?([A-Za-z][^.\n]{{4,140}})"),
    ("en_ie", r"\b{term}\b\s*,?\s*i\.?e\.?\s+([^.\n]{{4,140}})"),
    ("em_dash_bare", r"\b{term}\b\s*[—–]\s*([A-Za-z\u0400-\u04FF][^.\n]{{4,140}})"),
    ("en_by_i_mean", r"by\s+{term}\b\s+(?:i\s+mean|we\s+mean)\s+([^.\n]{{4,140}})"),
    ("parenthetical", r"\b{term}\b\s*\(\s*([^()]{{4,120}}?)\s*\)"),
    ("em_dash_eto", r"\b{term}\b\s*[—\-–]\s*это\s+([^.\n]{{4,140}})"),
    ("eto", r"\b{term}\b\s+это\s+([^.\n]{{4,140}})"),
    ("te", r"\b{term}\b\s*,?\s*т\.?\s*е\.?\s+([^.\n]{{4,140}})"),
    ("pod_imeyu", r"под\s+{term}\b\s+имею\s+в\s+виду\s+([^.\n]{{4,140}})"),
    ("rasshifr", r"\b{term}\b\s+расшифровыва(?:ется|ются)\s+как\s+([^.\n]{{4,140}})"),
    ("equals", r"\b{term}\b\s*=\s*([^.\n]{{4,140}})"),
    ("aka", r"\b{term}\b\s+(?:a\.?k\.?a\.?|aka)\s+([^.\n]{{4,140}})"),
    ("colon", r"\b{term}\b\s*:\s*([A-Za-z\u0400-\u04FF][^.\n]{{4,140}})"),
)
#: (label, whether case is ignored, pattern capturing a brand).
BRANDS = (
    ("worked_with_uk", True, r"(?:працював[ала]?|досвід(?:\s+роботи)?|стикався|знайомий)\s+з\s+([A-Z][\w\-\.]{3,30})\b"),
    ("representatives_uk", False, r"(?:представники|колеги\s+з|команд[аи]?\s+|співробітники\s+)\s*([A-Z][\w\-\.]{3,30})\b"),
    ("titled_provider_uk", True, r"(?:платіжка|провайдер[а-яіїє]*|компанi[а-яіїє]+|оператор[а-яіїє]*)\s+([A-Z][\w\-\.]{3,30})\b"),
    ("worked_with_ru", True, r"(?:работал[аи]?|опыт(?:\s+работы)?|сталкивал(?:ся|ась)|знаком[аы]?|знаете(?:\s+про)?)\s+с\s+([A-Z][\w\-\.]{3,30})\b"),
    ("representatives_ru", False, r"(?:представители|коллеги\s+из|команд[аы]?\s+|сотрудники\s+)\s*([A-Z][\w\-\.]{3,30})\b"),
    ("worked_with_en", True, r"(?:worked|experience|familiar|deal[ts]?)\s+with\s+([A-Z][\w\-\.]{3,30})\b"),
    ("scam_callout", True, r"\b([A-Z][\w\-\.]{3,30})\b\s*[-–—]?\s*(?:скам|scam|fraud|шахрайство|кидалово)"),
    ("titled_provider", True, r"(?:платежка|psp|провайдер[а-я]*|компани[а-я]+|оператор[а-я]*)\s+([A-Z][\w\-\.]{3,30})\b"),
    ("intro_signature", False, r"(?:[/,]|\bв\s+команд[іе]\s+)\s*([A-Z][a-zA-Z][\w\-\.]{2,28})\b\s*[\n,)/!.]"),
    ("domain", False, r"\b([a-zA-Z][\w\-]{2,28})\.(?:com|io|app|uk|net|co|gg|finance|pay|fi)\b"),
)
#: What brand patterns catch although it is none.
NOT_BRANDS = (
    "Україна", "Росія", "Білорусь", "Німеччина", "Франція", "Іспанія", "Польща", "Туреччина", "Китай", "Індія",
    "Понеділок", "Вівторок", "Середа", "Четвер", "Пятниця", "Субота", "Неділя", "Січень", "Лютий", "Березень",
    "Квітень", "Травень", "Червень", "Липень", "Серпень", "Вересень", "Жовтень", "Листопад", "Грудень", "Керівник",
    "Менеджер", "Директор", "Власник", "Партнер", "Привіт", "Дякую", "Hello", "Thanks", "Apple", "Google", "Visa",
    "Mastercard", "Maestro", "American", "Discover", "Telegram", "WhatsApp", "Facebook", "LinkedIn", "YouTube",
    "Twitter", "TRC-20", "ERC-20", "BEP-20", "Russia", "Ukraine", "Belarus", "Germany", "Spain", "France", "Italy",
    "Europe", "European", "USA", "Canada", "China", "India", "Japan", "Korea", "Brazil", "Mexico", "Turkey", "Latam",
    "MENA", "CIS", "Africa", "Asia", "Latin", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    "Sunday", "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December", "Head", "Chief", "Senior", "Junior", "Lead", "Account", "Business", "Payment", "Payments",
    "Manager", "Director", "Officer", "Development", "Sales", "Operations", "Product", "Owner", "EUR", "USD", "GBP",
    "INR", "KZT", "BRL", "MXN", "AZN", "Привет", "Спасибо",
)


def ready(patterns: Iterable[str], ignore_case: bool = True) -> tuple[str, ...]:
    """Patterns as Java takes them: all alphabets, any case."""
    return tuple(("(?iU)" if ignore_case else "(?U)") + p for p in patterns)


def brand_patterns() -> dict[str, str]:
    """Label to pattern, for ``mining.mine_brands``."""
    return {label: ready([pattern], ignore_case)[0] for label, ignore_case, pattern in BRANDS}
