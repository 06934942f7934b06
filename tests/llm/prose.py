"""Short paragraphs of plain prose, written by hand for the tests, in languages that have no list of function words."""

PROSE = {
    "pl": "Wczoraj wieczorem poszliśmy nad rzekę, żeby zobaczyć nowy most. Było już ciemno i padał drobny deszcz, ale na brzegu stało wielu ludzi. Stary rybak opowiadał dzieciom, jak dawniej przeprawiano się łodzią. Nikt nie wierzył, że most zostanie skończony przed zimą.",
    "it": "Quando sono arrivato in paese, la piazza era ancora vuota e il bar stava per aprire. Una donna anziana spazzava davanti alla porta e mi ha chiesto da dove venivo. Le ho detto che cercavo la casa di mio nonno, ma lei non ricordava quel nome. Alla fine mi ha offerto un caffè e abbiamo parlato del tempo.",
    "pt": "O barco saiu cedo, antes que o sol aparecesse atrás das montanhas. Os pescadores falavam pouco porque ainda tinham sono e fazia frio. Ao meio-dia voltaram com as redes quase vazias, mas ninguém parecia preocupado. O mais velho disse que o mar devolve sempre aquilo que guarda.",
    "nl": "Gisteren heeft mijn buurman eindelijk het dak van zijn schuur gerepareerd. Hij had er maanden over gedaan, omdat het steeds regende en hij weinig tijd had. Zijn dochter hielp hem met de planken en zette daarna koffie voor iedereen. Nu staat de fiets weer droog en is hij tevreden.",
    "sv": "På våren brukade vi gå till sjön så fort isen hade gått. Min bror ville alltid bada först, fast vattnet var så kallt att det gjorde ont. Mor satt på bryggan med en filt över knäna och läste högt ur tidningen. Jag minns fortfarande hur det luktade av tjära och våt ull.",
    "cs": "Když jsme přijeli na nádraží, vlak už stál u nástupiště a lidé do něj nastupovali. Babička nám mávala z okna a něco volala, ale nebylo jí rozumět. Cesta trvala celé odpoledne, protože jsme dvakrát čekali na jiný vlak. Večer jsme byli tak unavení, že jsme usnuli v kuchyni.",
    "ro": "Bunicul meu a lucrat toată viața la moară și nu s-a plâns niciodată. Dimineața pleca înainte de răsărit, cu o bucată de pâine și puțină brânză. Seara ne povestea despre oamenii care veneau de departe cu sacii în căruță. Acum moara este închisă, dar roata ei se mai vede de pe drum.",
    "tr": "Dün akşam komşumuz bize bahçesinden topladığı kirazları getirdi. Annem hemen bir tabak yıkadı ve hepimiz balkonda oturup yedik. Babam bu yıl havanın çok kurak gittiğini, ağaçların az meyve verdiğini söyledi. Biz de ona çocukken dalından yediğimiz kirazları hatırlattık.",
    "fi": "Kesällä asuimme mökillä, joka oli aivan järven rannalla. Isä nousi aina ensimmäisenä ja lämmitti saunan ennen kuin muut heräsivät. Me lapset uimme koko päivän ja söimme marjoja suoraan metsästä. Kun illat pimenivät, tiesimme että koulu alkaisi pian taas.",
    "hu": "A falu végén állt egy régi ház, amelyben már évek óta nem lakott senki. A gyerekek azt mesélték, hogy éjszaka fény látszik az ablakában. Egyszer az öcsém is odament, de csak egy macskát talált a padláson. Azóta mindig viszünk neki egy kis tejet, amikor arra járunk.",
    "el": "Το πρωί ο ήλιος δεν είχε βγει ακόμα όταν ξεκινήσαμε για το βουνό. Ο δρόμος ήταν στενός και γεμάτος πέτρες, αλλά η θέα άξιζε τον κόπο. Στην κορυφή βρήκαμε ένα μικρό εκκλησάκι με ανοιχτή πόρτα. Καθίσαμε εκεί για ώρα και φάγαμε το ψωμί που είχαμε μαζί μας.",
    "uk": "Щоліта ми їздили до бабусі, яка жила біля самого лісу. Вона пекла хліб у великій печі й давала нам ще теплу скоринку. Дід учив мене плести кошики, хоча в мене нічого не виходило. Тепер хата стоїть порожня, але яблуні в саду досі родять.",
    "ar": "وصلنا إلى القرية قبل غروب الشمس بقليل، وكانت الطريق طويلة ومتعبة. جلس الرجال أمام المسجد يتحدثون عن موسم الزيتون الذي تأخر هذا العام. قدمت لنا صاحبة البيت الشاي والخبز الساخن، ثم سألتنا عن أخبار المدينة. في الليل نمنا على السطح لأن الجو كان حارا جدا.",
    "he": "בבוקר הלכתי עם אבי אל השוק כדי לקנות ירקות ולחם לשבת. המוכר הזקן הכיר את כולם בשם ותמיד הוסיף לנו תפוח אחד במתנה. בדרך חזרה ירד גשם חזק ולא היה לנו איפה לעמוד. כשהגענו הביתה אמא צחקה ונתנה לנו בגדים יבשים.",
    "ja": "駅に着いたとき、もう雨がやんでいて、空には薄い雲が残っていた。祖母は改札の前で待っていて、私の荷物を持とうとした。二人で川沿いの道を歩きながら、昔の家の話をした。庭の柿の木は今年もたくさん実をつけたそうだ。",
    "ko": "어제 저녁에 우리는 강가에 새로 생긴 다리를 보러 갔다. 비가 조금 내리고 있었지만 많은 사람들이 우산을 쓰고 서 있었다. 할아버지는 예전에는 배를 타고 강을 건너야 했다고 말씀하셨다. 아이들은 그 이야기를 믿지 못하고 자꾸 다시 물어보았다.",
    "hi": "पिछले साल हम गर्मी की छुट्टियों में नानी के गाँव गए थे। वहाँ सुबह बहुत जल्दी होती थी और सब लोग खेत में काम करने चले जाते थे। नाना हमें पुराने पेड़ के नीचे बैठकर कहानियाँ सुनाते थे। शहर लौटने के बाद भी मुझे उस आँगन की याद आती है।",
    "vi": "Sáng nay trời mưa to nên tôi đi làm muộn hơn mọi ngày. Trên đường về, tôi ghé vào quán nhỏ của bà cụ ở đầu ngõ để uống trà. Bà kể rằng con trai bà vừa gửi thư từ nơi xa và hẹn sẽ về trước tết. Nghe bà nói, tôi chợt nhớ đến mẹ mình ở quê.",
    "id": "Setiap sore ayah duduk di depan rumah sambil memperbaiki jala yang robek. Ibu memanggil kami untuk makan sebelum hari menjadi gelap. Kadang-kadang paman datang membawa ikan dan bercerita tentang ombak yang tinggi. Kami tidak pernah bosan mendengarnya walaupun ceritanya selalu sama.",
    "th": "เมื่อวานนี้ฉันไปตลาดกับแม่ตั้งแต่เช้ามืด แม่ซื้อปลาและผักหลายอย่างเพื่อทำอาหารให้ทุกคนในบ้าน ระหว่างทางกลับเราเจอป้าข้างบ้านซึ่งกำลังรอรถอยู่ที่ป้าย เราจึงหยุดคุยกันนานจนลืมเวลา",
}
