"""Domain packs: the word lists of the built-in gates.

Terms come from glossaries and are given at run time; signals and stop words are fixed. A
list of card signals is longer than these and is a parameter of ``cards``.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.gates import DomainPack

# Results of the gates depend on these very words.
RECOVERY = (
    "recovery", "recover", "rekaver", "rekover", "rekavery", "recaver", "recavery", "ricovery",
    "рековери", "рекавери", "рекавер", "рековер", "рекаверь",
    "recovery leads", "database leads", "recovery chargeback",
)
CHARGEBACK = ("chardzeback", "chardgeback", "charge back", "chargeback", "чардж", "чарджбэк", "чарджбек", "чарджбэки")
SCAM = ("скам", "scam", "fraud", "мошен", "обнал", "vcc-букинг", "vcc букинг", "хайчек", "хай чек", "хай-чек")
AGGREGATORS = (
    "aggregator", "facilitator", "sub-acquirer", "subacquirer", "looking for merchants",
    "субэквайер", "суб-эквайер", "субеквайєр", "суб-еквайєр", "ищем трафик", "ищу трафик", "ищу траффик",
    "нужны платежные агенты", "предлагаем процессинг", "даю приемку", "есть приемка", "предлагаем приемку",
    "предоставляем приемку", "ищем залив", "ищем пролив", "ищу залив", "ищу пролив", "ищем продукты",
    "ищу продукты", "нужна площадка", "нужна плошадка",
)
SEEKING = (
    "ищу", "ищем", "ищет", "ищите", "поиске", "в поиске", "в поисках", "нужен", "нужна", "нужно", "нужны", "надо",
    "требуется", "требуются", "подскажите", "посоветуйте", "у кого есть", "кто может", "кто даст", "кто подскажет",
    "кто работает с", "ищется", "интересует", "интересуют", "хочу подключить", "ищу провайдера", "+1 в поиске",
    "у кого-то есть", "у кого-нибудь есть", "у вас есть", "если у вас есть", "есть у кого", "в кого есть", "у кого",
    "кто-то знает", "кто знает", "кто-то нашел", "кто нашел", "кто дает", "кто даёт", "кто процессит",
    "кто располагает", "располагает", "кто продает", "кто продаёт", "кто-то продает", "кто-то продаёт",
    "поделитесь", "постучитесь", "отпишите", "скиньте",
    "шукаю", "шукаємо", "шукає", "потрібен", "потрібна", "потрібно", "потрібні", "у кого є", "хто має", "цікавить", "порадьте",
    "looking for", "we need", "i need", "anyone have", "who has", "anyone got", "in search of", "need a", "need an",
    "searching for", "recommend a", "any recommendations", "who can provide",
)
SEEKING_COINS = ("ежедневно", "досрочно", "долгосрочно", "постоянно", "постоянной основе", "long-term", "regular basis", "on a daily basis", "our company")
PROVIDING = (
    "работаю по", "работаем по", "работаем с мерчант", "покрываю", "покрытие по", "покрыт по", "покрываем",
    "закрываем по", "закрываем гео", "закрываем eu", "закрываем uk", "закрываем latam", "процессим", "процессируем",
    "подключаем", "подключим", "онбордим", "онбординг мерчант", "можем закрыть", "можем подключить", "специализируемся",
    "предлагаем эквайринг", "предлагаем процессинг", "предлагаем шлюз", "предлагаем решение", "предлагаю эквайринг",
    "предлагаю процессинг", "апрув", "аппрув", "апрув рейт", "наш апрув", "наш роутинг", "наш каскад", "наш процессинг",
    "наш шлюз", "наш гейтвей", "наша компания", "наша команда", "наше решение", "работаем с высоким риском",
    "закрываем гемблинг", "закрываем форекс", "закрываем adult", "онбординг за", "подключение за", "быстрый онбординг",
    "пропоную", "пропонуємо", "маємо покриття", "маємо рішення", "підключаємо", "підключимо", "покриваємо", "закриваємо",
    "процесуємо", "еквайринг пропоную", "наша компанія", "наше рішення", "пишіть в лс", "стукайте в лс",
    "we offer", "we provide", "we process", "we cover", "we support", "we handle", "we specialize", "we specialise",
    "covering eu", "covering uk", "covering latam", "covering asia", "processing high-risk", "processing igaming",
    "processing gambling", "can process", "can handle", "able to process", "able to handle", "our gateway",
    "our processing", "our solution", "our platform", "our acquiring", "approve rate", "approval rate", "onboarding in",
    "onboarding within", "settlement t+", "rolling reserve", "high-risk acquiring", "high risk acquiring",
)
NOT_PROVIDING = (
    "sim-направление", "sim направление", "сим направление", "вход sim", "минусовые кредитки", "отработаю логи",
    "отрабатываю логи", "минусовые карты", "не льешь, но хочешь зарабатывать", "не льешь, но хочешь заработать",
    "реферальная система", "депозит лично под вас", "гарант любой на ваш вкус", "подключу к площадке",
    "подключу без страхового депозита", "подключайтесь к нам по лучшим условиям", "balance transfer", "billpay",
    "трейдеров", "трейдер", "для трейдер", "набор трейдер", "мануалы", "менторский состав", "куратор",
    "страховой депозит", "белый треугольник", "белые треугольники", "красный гринекс", "ставим на площадки",
    "подключайся через официального представителя", "подключу на площадку", "подключение к площадке",
    "wts/sell", "wts sell", "selling accounts", "ready acc", "kyc service", "costume name", "focus on traffic",
    "facebook storming", "stop wasting time", "white label который выдерживает", "wl которые",
)
GENERIC_PROVIDING = (
    "igaming", "gambling", "casino", "betting", "forex", "crypto", "nutra", "latam", "крипта", "vertical",
    "пишите в лс", "связь", "chargeback", "чарджбэк", "чарджбек", "поддержка", "платежных систем", "платежи",
    "платёжный", "payment infrastructure", "payment partner", "платежных системах", "ставки", "gmatch", "логі",
)
TRAFFIC = (
    "ищу оффер", "нужен оффер", "ищу партнерку", "ищу партнёрку", "ищу рекламодателя", "ищу рекла", "нужна партнерка",
    "под мой трафик", "под мій трафік", "ищу оффер под", "ищу партнёрку под", "продаю трафик", "продам трафик",
    "продаю трафiк", "продам трафiк", "есть трафик", "є трафiк", "имею трафик", "сливаю трафик", "слив трафика",
    "слить трафик", "отливаю трафик", "отлив трафика", "гоню трафик", "залью трафик", "заливаю трафик", "лью трафик",
    "льем трафик", "продаю лиды", "продам лиды", "продаю ліди", "есть лиды", "є ліди", "лидген", "лидогенерация",
    "лідген", "лідогенерація", "генерирую лиды", "генерую ліди", "покупаю трафик", "куплю трафик", "нужен трафик",
    "нужны лиды", "ищу трафик", "ищем трафик", "принимаю трафик", "интересует трафик", "купим трафик",
    "ищу вебмастер", "ищем вебмастер", "нужен вебмастер", "нужны вебмастер", "ищу арбитражник", "нужен арбитражник",
    "ищем арбитражник", "работаем с вебмастерами", "сотрудничаем с вебмастерами", "арбитражник", "арбитражники",
    "вебмастер", "медиабаер", "медиабайер", "медіабаєр", "cpa оффер", "cpa offer", "cpa сетк", "cpa network",
    "ревшар", "rev share", "revshare", "ftd", "first time deposit", "selling traffic", "have traffic",
    "traffic for sale", "traffic seller", "traffic buyer", "buying traffic", "need traffic", "looking for traffic",
    "seeking traffic", "have leads", "selling leads", "lead generation", "looking for offer", "seeking offer",
    "looking for affiliate", "seeking advertiser", "looking for webmaster", "seeking webmaster",
    "performance marketing", "affiliate network", "affiliate program", "media buyer", "гемблинг трафик",
    "трафик на гемблинг", "трафик на казино", "казино трафик", "трафик на нутру", "нутра трафик", "трафик на крипт",
    "крипт", "трафик на форекс", "форекс трафик", "трафик на дейтинг", "дейтинг трафик", "трафик на адалт",
    "адалт трафик", "трафик на беттинг", "беттинг трафик", "gambling traffic", "casino traffic", "nutra traffic",
    "crypto traffic", "forex traffic", "dating traffic", "adult traffic", "betting traffic", "igaming traffic",
)
NOT_TRAFFIC = (
    "страховой депозит", "рапира", "трансгран", "геймбет", "гембет", "белые треугольники", "апелляции: до",
    "rapira net", "pdf чеки", "пдф чеки", "мобком", "мобильная коммерция", "бт-трафик", "bt трафик", "метчинг",
    "мэтчинг", "pay in", "pay out", "payin", "payout", "с2с", "c2c", "нспк", "набор трейдеров", "набор тимлидов",
    "площадка для трейдеров", "подключаю трейдеров", "поставлю трейдеров", "flash btc", "flash usdt", "flash coins",
    "fake btc", "платежное решение", "платёжное решение",
)
NOT_CARDS = (
    "покупка usdt через сбп", "вывод на карту переводом", "вывод на карту от биржи",
    "вывод на карту от официальной биржи", "p2p обмен", "трейдер p2p", "p2p трейдер", "обменяю usdt", "обменяю btc",
    "flash usdt", "flash btc", "flash coins", "fake btc", "fake usdt", "payment gateway", "платёжный шлюз",
    "платежный шлюз", "эквайринг", "acquiring solution", "chargeback", "recovery leads", "database leads",
    "recovery chargeback", "returned victims", "ищем менеджера", "ищем разработчика", "вакансия", "job opening",
    "we are hiring", "hiring now", "open position",
)


def buyers(terms: Sequence[str] = ()) -> DomainPack:
    """Who seeks a payment service."""
    return DomainPack(tuple(terms), SEEKING)


def coin_buyers(terms: Sequence[str] = ()) -> DomainPack:
    """Who seeks coins regularly."""
    return DomainPack(tuple(terms), SEEKING + SEEKING_COINS)


def providers(terms: Sequence[str] = (), mode: str = "or") -> DomainPack:
    """Who offers a payment service; generic terms alone say nothing."""
    return DomainPack(tuple(terms), PROVIDING, NOT_PROVIDING + RECOVERY, GENERIC_PROVIDING, mode)


def traffic(terms: Sequence[str] = ()) -> DomainPack:
    """Who buys or sells advertising traffic."""
    return DomainPack(tuple(terms), TRAFFIC, NOT_TRAFFIC + RECOVERY + CHARGEBACK)


def cards(terms: Sequence[str] = (), signals: Sequence[str] = ()) -> DomainPack:
    """Who seeks or offers coin cards; signals are a parameter."""
    return DomainPack(tuple(terms), tuple(signals), NOT_CARDS)


def fixed_lists() -> dict[str, tuple[str, ...]]:
    """All lists by name."""
    return {name.lower(): value for name, value in globals().items() if name.isupper() and isinstance(value, tuple)}
