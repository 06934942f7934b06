"""Inspected kinds of pages, as small generators of examples.

What was seen while reading crawled pages is written down here as rules: how prose of several layouts, honest lists and tables,
code and noise, and the kinds of spam look. The models of problems 2 and 5 get their directions
and the names of their components from these examples only, never from a page's identity.
"""

from __future__ import annotations

import random

#: Nouns, shop words and sentence frames by language (fixed values); ``_`` takes a word, ``#`` a number.
NOUNS = {
    "en": "garden bridge kettle lantern market window letter river engine harbour blanket teacher ladder orchard ticket museum".split(),
    "de": "Garten Brücke Kessel Laterne Markt Fenster Brief Fluss Motor Hafen Decke Lehrer Leiter Wiese Karte Museum".split(),
    "fr": "jardin pont bouilloire lanterne marché fenêtre lettre rivière moteur port couverture maître échelle verger billet musée".split(),
    "es": "jardín puente tetera farol mercado ventana carta río motor puerto manta maestro escalera huerto billete museo".split(),
    "ru": "сад мост чайник фонарь рынок окно письмо река мотор порт одеяло учитель лестница двор билет музей".split(),
    "zh": "花园 桥梁 水壶 灯笼 市场 窗户 书信 河流 发动机 港口 毯子 老师 梯子 果园 车票 博物馆".split(),
}
SHOP = {
    "en": "cheap buy online sale best price deals discount free shipping order top near shop rated".split(),
    "de": "günstig kaufen online angebot beste preis rabatt shop versand bestellen top".split(),
    "fr": "pas cher acheter ligne promo prix livraison soldes boutique meilleur commander".split(),
    "es": "barato comprar línea oferta precio envío tienda mejor descuento pedir".split(),
    "ru": "купить дёшево онлайн цена скидка доставка магазин лучший заказать распродажа".split(),
    "zh": "便宜 购买 在线 价格 折扣 包邮 最佳 优惠 商店".split(),
}
FRAMES = {
    "en": [
        "They repaired the _ near the _ because it had not been used for # years.",
        "In the evening she walked to the _ with a _, and he told her what was in the _.",
        "When the _ was opened, many of them said that no _ had ever looked so good.",
        "There were # people at the _, each with a _ and a _ from the old _.",
    ],
    "de": [
        "Sie haben die alte _ bei dem _ repariert, weil sie seit # Jahren nicht benutzt worden war.",
        "Am Abend ging sie mit einer _ zu der _, und er sagte ihr, was in dem _ war.",
        "Als das _ geöffnet wurde, war die _ für # Tage bei dem _ zu sehen.",
    ],
    "fr": [
        "Ils ont réparé la _ près de la _, car elle n'avait pas été ouverte depuis # ans.",
        "Le soir, elle est allée à la _ avec un _, et il a dit ce qui était dans le _.",
        "Quand le _ a été ouvert, nous avons vu la _ et le _ dans la ville.",
    ],
    "es": [
        "Han reparado el _ cerca de la _, porque no se había abierto en # años.",
        "Por la tarde fue a la _ con un _, y él dijo lo que había en el _.",
        "Cuando el _ fue abierto, todos fueron a la _ con el _ de la ciudad.",
    ],
    "ru": [
        "Они починили _, потому что его не открывали уже # дней, и это был старый _.",
        "Вечером она пошла на _, а он сказал, что в городе есть _ и ещё # других.",
        "Когда открыли _, на улице был _, который раньше стоял у _.",
    ],
    "zh": [
        "因为_太远，所以我们只看到了_和_，没有去_。",
        "晚上他们打开了古老的_，后来又修理了_和#个_。",
        "如果没有_，这里的_就不会被打开，这是老师的看法。",
    ],
}
SYLLABLES = "ba de fi lo mu ra sen tor vel nim kar dol gri pa sho wen".split()

PROSE, LIST, TABLE, JUNK, SPAM = "prose", "list", "table", "junk", "spam"


class Maker:
    """Random examples of one language."""

    def __init__(self, lang: str, rng: random.Random):
        self.lang, self.r = lang, rng
        self.gap = "" if lang == "zh" else " "

    def made_up(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(2, 3)))

    def word(self) -> str:
        if self.lang in ("zh", "ru") or self.r.random() < 0.5:
            return self.r.choice(NOUNS[self.lang])
        return self.made_up()

    def name(self) -> str:
        if self.lang == "zh":
            return "".join(self.r.sample("李王张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗", 3))
        return f"{self.made_up().title()} {self.made_up().title()}"

    def sentence(self) -> str:
        frame = self.r.choice(FRAMES[self.lang])
        return "".join(self.word() if c == "_" else str(self.r.randint(2, 3000)) if c == "#" else c for c in frame)

    def paragraph(self, n: int | None = None) -> str:
        return self.gap.join(self.sentence() for _ in range(n or self.r.randint(2, 5)))

    def body(self) -> str:
        return "\n".join(self.paragraph() for _ in range(self.r.randint(2, 5)))

    def title(self) -> str:
        r = self.r
        if self.lang == "zh":
            return f"{self.word()}的著名的{self.word()}和{self.word()}，{self.name()}"
        kind = r.randint(0, 2)
        if kind == 0:
            return f"{self.made_up().title()}: {self.word()} / {self.word()} {self.word()}"
        join = {"en": "and the", "de": "und die", "fr": "et la", "es": "y la", "ru": "и"}[self.lang]
        return f"{self.name()}, {self.word()} {join} {self.word()}" if kind == 1 else f"{self.word().title()} {join} {self.word()} {self.word()}: {self.made_up().title()}"

    def site(self) -> str:
        return f"{self.made_up()}-{self.made_up()}.example"

    def link(self) -> str:
        r = self.r
        tail = r.choice([f"?id={r.randint(2, 4000)}", "-".join(self.made_up() for _ in range(r.randint(1, 4))), "", "p"])
        return r.choice(["https://", "http://", "www.", ""]) + f"{self.site()}/{tail}"

    def lead(self) -> str:
        """At times a title or one sentence opens a page that has nothing else to say."""
        x = self.r.random()
        return self.title() + "\n" if x < 0.2 else self.sentence() + "\n" if x < 0.5 else ""

    # prose

    def p_plain(self):
        return self.body()

    def p_one_line(self):
        return self.body().replace("\n", self.gap)

    def p_wrapped(self):
        out, line = [], ""
        if self.lang == "zh":
            t = self.body()
            return "\n".join(t[i : i + 30] for i in range(0, len(t), 30))
        for w in self.body().split():
            if len(line) + len(w) > 55:
                out.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        return "\n".join([*out, line])

    def p_lower(self):
        bare = "".join(c for c in self.body().lower() if c.isalnum() or c.isspace())
        return bare if self.lang != "zh" else self.body()

    def p_quotes(self):
        return "\n".join(self.r.choice(["“{}”", "– {}", "»{}«"]).format(self.sentence()) for _ in range(self.r.randint(6, 18)))

    def p_with_list(self):
        items = "\n".join(f"- {self.word()} {self.r.randint(2, 90)}" for _ in range(self.r.randint(3, 6)))
        return f"{self.body()}\n{items}\n{self.body()}"

    def p_with_ends(self):
        menu = " | ".join(self.word().title() for _ in range(4))
        tail = "\n".join(f"{self.title()}, https://{self.site()}/{self.r.randint(2, 900)}" for _ in range(3))
        tags = "Tags: " + ", ".join(self.word() for _ in range(6))
        return f"{menu}\n{self.body()}\n{self.r.choice([tail, tags, '© 2020 ' + self.site()])}"

    # lists and tables

    def l_titles(self):
        return "\n".join(f"{self.r.choice('*-•')} {self.title()}" for _ in range(self.r.randint(10, 30)))

    def l_names(self):
        return self.r.choice(["; ", ", ", "\n", " / "]).join(self.name() for _ in range(self.r.randint(25, 80)))

    def l_recipe(self):
        the = self.r.choice({"de": ["die ", "das ", ""], "fr": ["la ", "le ", ""], "es": ["la ", "el ", ""]}.get(self.lang, [""]))

        def one():
            return f"{self.r.choice([50, 150, 250, 400])} g {the}{self.word()}" if self.r.random() < 0.6 else f"{self.r.randint(1, 6)} x {the}{self.word()}, {self.word()}"

        return "\n".join(one() for _ in range(self.r.randint(10, 26)))

    def l_contents(self):
        return "\n".join(f"{self.title()} {'.' * self.r.randint(5, 30)} {self.r.randint(2, 400)}" for _ in range(self.r.randint(12, 28)))

    def l_dated(self):
        return "\n".join(f"{self.r.randint(1, 28)}.{self.r.randint(1, 12)}.20{self.r.randint(10, 29)} {self.title()}" for _ in range(self.r.randint(12, 28)))

    def l_glossary(self):
        return "\n".join(f"{self.word()} - {self.word()} {self.word()}" for _ in range(self.r.randint(14, 30)))

    def t_columns(self):
        gap = self.r.choice(["    ", "\t", " | "])
        rows = [f"{i}{gap}{self.word().title()}{gap}{self.r.randint(2, 9000)}{gap}{self.r.randint(2, 90)}.{self.r.randint(0, 9)}0" for i in range(1, self.r.randint(9, 22))]
        return "\n".join([gap.join(["No", "Name", "Qty", "Unit"]), *rows])

    def t_records(self):
        return "\n".join(f"{self.name()}, {self.r.randint(1990, 2030)}, {self.r.randint(1, 99)}, {self.r.randint(100, 500)}." for _ in range(self.r.randint(12, 24)))

    def t_times(self):
        return "\n".join(f"{self.r.randint(6, 23):02}:{self.r.randint(0, 59):02}  {self.made_up().title()} {self.r.choice('->')} {self.made_up().title()}  {self.r.randint(1, 12)}" for _ in range(self.r.randint(10, 22)))

    def t_results(self):
        return "\n".join(f"{self.made_up().title()} - {self.made_up().title()} {self.r.randint(0, 5)}:{self.r.randint(0, 5)}" for _ in range(self.r.randint(12, 28)))

    # junk

    def j_code(self):
        def one():
            a, b = self.made_up(), self.made_up()
            return self.r.choice([f"var {a}=function(a,b){{return a[{self.r.randint(0, 9)}]||b.{b}({self.r.randint(1, 99)});}};", f".{a}-{b}{{margin:{self.r.randint(0, 20)}px;color:#{self.r.randint(0, 0xFFFFFF):06x};}}"])

        return "\n".join(one() for _ in range(self.r.randint(10, 26)))

    def j_log(self):
        r = self.r
        return "\n".join(f"2031-0{r.randint(1, 9)}-1{r.randint(0, 9)} {r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)},{r.randint(100, 999)} {r.choice(['INFO', 'WARN', 'ERROR'])} [{self.made_up()}-{r.randint(1, 9)}] {self.made_up()}={r.randint(10, 9999)} rc={r.randint(0, 3)} {self.made_up()}" for _ in range(r.randint(12, 30)))

    def j_base64(self):
        chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        width = self.r.choice([76, 400])
        return "\n".join("".join(self.r.choice(chars) for _ in range(width)) for _ in range(self.r.randint(4, 16) if width == 76 else 1))

    def j_garbled(self):
        return "".join(self.r.choice(["�", chr(self.r.randint(0xC0, 0x17F)), chr(self.r.randint(33, 126)), " "]) for _ in range(self.r.randint(200, 700)))

    def j_drawn(self):
        return "\n".join(self.r.choice(["=-", "~. ", "* ", "_ ", "|_|"]) * self.r.randint(15, 50) + self.made_up() for _ in range(self.r.randint(4, 12)))

    def j_spaced(self):
        return " ".join(self.paragraph(2).replace(" ", ""))

    def j_misread(self):
        return self.body().encode().decode("latin-1") if self.lang in ("ru", "zh") else self.j_garbled()

    def j_random(self):
        letters = "abcdefghijklmnopqrstuvwxyz"
        return " ".join("".join(self.r.choice(letters) for _ in range(self.r.randint(2, 11))) for _ in range(self.r.randint(40, 160)))

    # spam

    def _keys(self, n=3):
        return [self.word() for _ in range(self.r.randint(1, n))]

    def _case(self, w):
        return self.r.choice([w, w.upper(), w.title(), w])

    def _shop(self):
        return self.r.choice(SHOP[self.lang])

    def s_repeated(self):
        keys = self._keys() + self.r.sample(SHOP[self.lang], 2)
        return self.lead() + self.r.choice([" | ", " - ", " ", ", "]).join(self._case(self.r.choice(keys)) for _ in range(self.r.randint(40, 160)))

    def s_misspelt(self):
        key = self.word()
        forms = [key, key + "s", key[:-1], key + key[-1], self._shop() + key, key.title(), key.replace("e", "3", 1)]
        return self.lead() + " ".join(self.r.choice(forms) for _ in range(self.r.randint(40, 120)))

    def s_offers(self):
        keys = self._keys(2)

        def line():
            return " ".join(self._case(self.r.choice([self._shop(), *keys])) for _ in range(self.r.randint(5, 9))) + self.r.choice(["!", ".", ""])

        return self.lead() + "\n".join(line() for _ in range(self.r.randint(8, 24)))

    def s_places(self):
        key, sep = self._case(" ".join([self._shop() * (self.r.random() < 0.5), self.word()]).strip()), self.r.choice(["\n", ", "])
        return self.lead() + sep.join(f"{key} {self.made_up().title() if self.lang != 'zh' else self.name()}" for _ in range(self.r.randint(25, 70)))

    def s_tags(self):
        pool = [self.word() for _ in range(self.r.randint(5, 18))]
        sep = self.r.choice([", ", " #", ", "])
        return self.lead() + self.r.choice(["Tags: ", "Keywords - ", "#", ""]) + sep.join(" ".join(self.r.sample(pool, self.r.randint(1, 2))) for _ in range(self.r.randint(30, 110)))

    def s_hashtags(self):
        pool = [self.word() for _ in range(self.r.randint(5, 14))]
        return self.lead() + " ".join("#" + "".join(self.r.sample(pool, self.r.choice([1, 1, 2]))) for _ in range(self.r.randint(25, 110)))

    def s_cloud(self):
        pool = [self.word() for _ in range(self.r.randint(5, 12))]
        return self.lead() + "\n".join(f"{self.r.choice(pool)} ({self.r.randint(2, 99)})" for _ in range(self.r.randint(18, 45)))

    def s_products(self):
        pool = [self.word() for _ in range(3)]

        def half():
            return f"{self.r.choice(pool)} {self.r.choice(['old', 'new', self.word(), self._shop()])} {self.r.choice(['36', '38', '40', 'S', 'L', 'XL'])}"

        return self.lead() + "\n".join(f"{half()} {half()[: self.r.randint(5, 30)]} {self._shop()}" for _ in range(self.r.randint(14, 30)))

    def s_pairs(self):
        pool = [self.word() for _ in range(self.r.randint(3, 6))]
        return self.lead() + ", ".join(f"{self.r.choice(pool)} {self._shop()}" for _ in range(self.r.randint(30, 90)))

    def s_loose(self):
        sep = self.r.choice([" » ", " · ", " > ", " * "])
        return sep.join(f"{self._shop()} " + " ".join(self.word() for _ in range(self.r.randint(1, 3))) for _ in range(self.r.randint(8, 45)))

    def s_stuffed(self):
        keys, out = self._keys(3), []
        if self.r.random() < 0.4:
            keys = [f"{self._shop()} {k}" for k in keys]
        text = self.paragraph(self.r.randint(2, 4))
        pieces = list(text) if self.lang == "zh" else text.split()
        for p in pieces:
            out.append(p)
            if self.r.random() < (0.2 if self.lang == "zh" else 0.55):
                out.append(self.r.choice(keys))
        return self.gap.join([*out, *(self.r.choice(keys) for _ in range(self.r.randint(0, 20)))])

    def s_anchors(self):
        return self.lead() + self.r.choice([" ", "\n"]).join(f"<a href={self.site()}>{' '.join(self._case(self.word()) for _ in range(self.r.randint(1, 4)))}</a>" for _ in range(self.r.randint(10, 40)))

    def s_directory(self):
        return self.lead() + "\n\n".join(f"{' '.join(self._case(self.word()) for _ in range(self.r.randint(1, 4)))}\n{self.link()}" for _ in range(self.r.randint(10, 36)))

    def s_inline_links(self):
        return self.lead() + self.r.choice([" | ", " ", "\n"]).join(f"{self.word()} {self.link()}" for _ in range(self.r.randint(10, 40)))

    def s_urls(self):
        return self.lead() + "\n".join(self.link() for _ in range(self.r.randint(12, 45)))


KINDS = {"p": PROSE, "l": LIST, "t": TABLE, "j": JUNK, "s": SPAM}


def examples(per_kind: int = 4, seed: int = 11) -> list[tuple[str, str, str]]:
    """``(kind, class, text)``, the same on every call: ``per_kind`` of each kind and language."""
    rng = random.Random(seed)
    out = []
    for lang in NOUNS:
        maker = Maker(lang, rng)
        for kind in sorted(k for k in dir(Maker) if k[:2] in {f"{x}_" for x in KINDS}):
            for k in range(per_kind):
                foot = f"\n© 20{rng.randint(10, 30)} {maker.site()}" if k % 4 == 3 else ""
                out.append((kind, KINDS[kind[0]], getattr(maker, kind)() + foot))
    return out
