"""The jobs' settings as data: one row a country and trade, for cleaning, formatting and listing checks.

Everything below is fixed values: word lists, translations and column names that the tables have to carry.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from harrow.functions.emails import Rules

TEMPLATE = (
    "No.", "Công ty", "Chức danh", "Người liên hệ", "SĐT", "Liên Hệ", "Email", "Liên Hệ mail", "Địa chỉ", "Lương", "Ngày đăng", "Hạn tuyển",
    "Check gửi", "Last Subject", "Last Body HTML", "Trạng thái Reply", "Lần Follow-up", "Ngày Follow-up gần nhất", "Mailbox đã dùng",
)
EMPLOYERS = (
    "No.", "Tên chủ sử dụng", "SĐT chủ", "SĐT môi giới", "Địa điểm làm việc", "Ngành nghề", "Thứ tự ưu tiên", "Số lượng tuyển (Quota)",
    "Quốc tịch mong muốn", "Thời hạn mong muốn", "Ngày hết hạn", "Email liên hệ", "Ngoại ngữ khác", "Mô tả công việc (JD)",
    "Điều kiện lao động (Lương/Ăn ở)", "Link chi tiết",
)
HOT_LEADS = ("No.", "Điểm đánh giá", "Xếp loại Lead", "Lý do xếp hạng", *EMPLOYERS[1:])

AU_CARS = {
    "auto repair shop": "Gara sửa chữa ô tô", "car repair and maintenance service": "Dịch vụ sửa chữa và bảo dưỡng ô tô",
    "automobile manufacturer": "Nhà máy sản xuất ô tô", "car manufacturer": "Nhà máy sản xuất ô tô", "car factory": "Nhà máy sản xuất ô tô",
}
GR_BROKERS = {
    "εταιρεία συμβουλευτικών υπηρεσιών ανθρώπινου δυναμικού": "Công ty tư vấn nhân sự Hy Lạp", "γραφείο εύρεσης προσωπικού": "Văn phòng tuyển dụng Hy Lạp",
    "γραφείο απασχόλησης": "Văn phòng giới thiệu việc làm Hy Lạp",
}
AU_BUILDERS = {
    "contractor": "Thầu xây dựng", "construction company": "Công ty xây dựng", "home builder": "Nhà thầu xây dựng nhà ở",
    "office refurbishment service": "Dịch vụ cải tạo văn phòng", "excavating contractor": "Nhà thầu đào móng / san lấp",
    "custom home builder": "Nhà thầu xây nhà theo yêu cầu",
}
LV_BUILDERS = {
    "celtniecības uzņēmums": "Công ty xây dựng", "demontāžas darbuzņēmējs": "Thi công phá dỡ", "betonēšanas pakalpojumu sniedzējs": "Thi công bê tông",
    "ceļu būves uzņēmums": "Xây dựng đường xá", "būvuzņēmums": "Công ty xây dựng chung",
}
LV_FISH = {
    "zivju apstrādes uzņēmums": "Công ty chế biến cá", "ražotājs": "Nhà sản xuất", "konservu fabrika": "Nhà máy đồ hộp", "zivju ferma": "Trại cá",
    "akvakultūras ferma": "Trại nuôi trồng thủy sản", "jūras velšu vairumtirgotājs": "Nhà bán buôn hải sản",
}
GR_HOTELS = {
    "ξενοδοχείο 5 αστέρων": "Khách sạn 5 sao", "κατ' οίκον φιλοξενία": "Homestay / Nhà nghỉ gia đình", "ξενοδοχείο": "Khách sạn",
    "ξενοδοχείο 4 αστέρων": "Khách sạn 4 sao", "ξενοδοχείο 3 αστέρων": "Khách sạn 3 sao", "ξενοδοχείο 2 αστέρων": "Khách sạn 2 sao",
    "ξενοδοχείο 1 αστέρων": "Khách sạn 1 sao", "ξενοδοχείο παρατεταμένης διαμονής": "Khách sạn lưu trú dài ngày", "χόστελ": "Nhà nghỉ tập thể (Hostel)",
    "μοτέλ": "Nhà nghỉ ven đường (Motel)",
}
PT_HOTELS = {
    "hospedaria": "Nhà khách / Guesthouse", "hotel de 3 estrelas": "Khách sạn 3 sao", "hotel": "Khách sạn", "hotel de 5 estrelas": "Khách sạn 5 sao",
    "hotel de 4 estrelas": "Khách sạn 4 sao", "hotel resort": "Khách sạn nghỉ dưỡng (Resort)", "hospedagem domiciliar": "Homestay / Nhà nghỉ gia đình",
    "hotel de 2 estrelas": "Khách sạn 2 sao", "albergue": "Nhà trọ / Hostel",
}
LV_METAL = {
    "metāla darbnīca": "Xưởng gia công kim loại", "metālapstrāde": "Gia công kim loại", "metāla konstrukcijas": "Kết cấu kim loại",
    "metāla izstrādājumu ražotājs": "Nhà sản xuất sản phẩm kim loại", "metāllūžņu sniedzējs": "Nhà cung cấp phế liệu kim loại",
    "metālapstrādes uzņēmums": "Công ty gia công kim loại", "metālizstrādājumu ražotājs": "Nhà sản xuất đồ kim loại", "metāla ražotājs": "Nhà sản xuất kim loại",
    "nerūsejošā tērauda piegādātājs": "Nhà cung cấp thép không gỉ", "tērauda piegādātājs": "Nhà cung cấp thép", "metāla jumts": "Mái kim loại",
    "metāla detaļu ražotājs": "Nhà sản xuất phụ tùng kim loại", "metālapstrādes pakalpojumi": "Dịch vụ gia công kim loại",
}
SK_AGENCIES = {
    "Pracovná agentúra": "Đại lý lao động", "Personálne poradenstvo": "Tư vấn nhân sự", "Agentúra pre sprostredkovanie práce": "Đại lý môi giới việc làm",
    "Sprostredkovanie práce": "Môi giới việc làm",
}
SK_FACTORIES = {
    "Strojná dielňa": "Xưởng cơ khí", "Výrobca autodielov": "Nhà sản xuất phụ tùng ô tô", "Výrobca": "Nhà sản xuất",
    "Dodávateľ železobetónových konštrukcií": "Nhà cung cấp kết cấu bê tông cốt thép", "Chemický závod": "Nhà máy hóa chất",
    "Továreň na automobily": "Nhà máy sản xuất ô tô", "Továreň na čokoládu": "Nhà máy sản xuất sô-cô-la", "Továreň na topánky": "Nhà máy sản xuất giày",
    "Výrobca elektroniky": "Nhà sản xuất thiết bị điện tử", "Kovovýroba": "Gia công / Sản xuất kim loại",
    "Dodávateľ výrobkov z plastu": "Nhà cung cấp sản phẩm nhựa", "Spoločnosť vyrábajúca plastové diely": "Công ty sản xuất linh kiện nhựa",
    "Služby vstrekovania plastov": "Dịch vụ đúc phun nhựa", "Dodávateľ výrobkov z gumy": "Nhà cung cấp sản phẩm cao su", "Výrobca batérií": "Nhà sản xuất pin",
    "Sklad": "Kho bãi / Nhà kho", "Prenájom skladovacích priestorov": "Cho thuê kho bãi", "Areál spoločnosti": "Khuôn viên công ty",
    "Firemná kancelária": "Văn phòng công ty",
}
TW_BUILDERS = {
    "建築公司": "Công ty xây dựng", "房屋建造商": "Đơn vị xây dựng nhà", "工程外判商": "Nhà thầu phụ công trình", "承包商": "Nhà thầu",
    "自訂房屋建築商": "Đơn vị xây dựng nhà theo yêu cầu", "土木工程公司": "Công ty công trình dân dụng / Kỹ thuật dân dụng",
    "建築修復服務": "Dịch vụ phục hồi / trùng tu công trình",
}
TW_FACTORIES = {
    "工廠設備供應商": "Nhà cung cấp thiết bị nhà máy", "家具製造商": "Nhà sản xuất đồ nội thất", "電子產品製造商": "Nhà sản xuất sản phẩm điện tử",
    "電子零件供應商": "Nhà cung cấp linh kiện điện tử", "玩具製造商": "Nhà sản xuất đồ chơi", "食品製造商": "Nhà sản xuất thực phẩm",
    "食品調味料製造商": "Nhà sản xuất gia vị thực phẩm", "冷凍食品製造商": "Nhà sản xuất thực phẩm đông lạnh", "化學工廠": "Nhà máy hóa chất",
    "化學品製造商": "Nhà sản xuất hóa chất", "機械製造商": "Nhà sản xuất máy móc", "機械廠": "Nhà máy cơ khí", "機械零件製造商": "Nhà sản xuất phụ tùng máy móc",
    "汽車零件製造商": "Nhà sản xuất phụ tùng ô tô", "塑料製造公司": "Công ty sản xuất nhựa", "塑膠製品供應商": "Nhà cung cấp sản phẩm nhựa", "紡織廠": "Nhà máy dệt",
    "紗廠": "Nhà máy kéo sợi", "服裝與布料製造商": "Nhà sản xuất quần áo và vải", "布產品製造商": "Nhà sản xuất sản phẩm vải", "電池製造商": "Nhà sản xuất pin",
    "玻璃製造商": "Nhà sản xuất thủy tinh", "玻璃纖維供應商": "Nhà cung cấp sợi thủy tinh", "鞋廠": "Nhà máy giày", "汽車工廠": "Nhà máy sản xuất ô tô",
    "造紙廠": "Nhà máy sản xuất giấy", "半導體供應商": "Nhà cung cấp bán dẫn", "橡膠製品供應商": "Nhà cung cấp sản phẩm cao su",
    "扣件供應商": "Nhà cung cấp chốt đai ốc (bu lông đai ốc)", "製造商": "Nhà sản xuất", "電子公司": "Công ty điện tử", "公司辦公室": "Văn phòng công ty",
}
TW_JOBS = {
    "製造工": "Lao động sản xuất / Chế tạo", "營造工": "Lao động xây dựng", "家庭看護工": "Lao động chăm sóc gia đình / Khán hộ công",
    "海洋漁撈": "Đánh bắt hải sản / Ngư nghiệp", "農林牧或養殖漁業工作": "Nông lâm ngư nghiệp hoặc chăn nuôi nuôi trồng thủy sản",
    "外國技術人力農林牧或養殖漁業技術工作": "Kỹ thuật viên nông lâm ngư nghiệp hoặc nuôi trồng thủy sản",
    "廢棄物及資源物回收處理工作": "Tái chế và xử lý chất thải, tài nguyên", "外展農務工作": "Lao động nông nghiệp dịch vụ / Outreach nông nghiệp",
    "雙語翻譯": "Phiên dịch song ngữ", "外國技術人力製造技術工作": "Kỹ thuật viên sản xuất / Chế tạo", "家庭幫傭": "Giúp việc gia đình",
    "屠宰工": "Lao động giết mổ / Slaughterhouse worker",
}
LV_WOOD = {
    "galdniecība": "Xưởng mộc", "mēbeļu izgatavotājs": "Nhà sản xuất đồ nội thất gỗ", "galdnieks": "Thợ mộc", "kokmateriālu piegādātājs": "Nhà cung cấp gỗ",
    "kokzāģētava": "Xưởng cưa gỗ",
}
NZ_FARMS = (
    "farm", "orchard", "crop grower", "agricultural production", "organic farm", "vineyard", "greenhouse", "plant nursery", "tree farm", "truck farmer",
    "pick your own farm produce", "dairy farm", "cattle farm", "livestock producer", "pig farm", "poultry farm", "honey farm", "horsestable studfarm",
    "christmas tree farm", "orchid farm", "orchid grower", "aquaculture farm", "fish farm", "seafood farm", "shrimp farm",
)

@dataclass(frozen=True)
class Cleaning:
    """Category filter of the cleaning step; how cells are compared and whether blank ones pass. No values: no filter."""

    values: tuple[str, ...] = ()
    contains: bool = False
    lower: bool = True
    blank: bool = True


@dataclass(frozen=True)
class Cells:
    """Input columns of each value, in the order in which they are tried.

    take: `filled` is the first cell that isn't blank, without blanks at its ends; `present` the first that isn't empty; `first` the first
    column's cell, shown as it is. site is what ranks rows of one name, link what is shown; likewise name and shown.
    """

    name: tuple[str, ...] = ("Name",)
    shown: tuple[str, ...] = ("Name",)
    email: tuple[str, ...] = ("Email",)
    phone: tuple[str, ...] = ("Phone",)
    site: tuple[str, ...] = ("Website",)
    link: tuple[str, ...] = ("Website",)
    address: tuple[str, ...] = ("Address",)
    category: tuple[str, ...] = ("Category",)
    pay: tuple[str, ...] = ()
    until: tuple[str, ...] = ()
    broker: tuple[str, ...] = ()
    tier: tuple[str, ...] = ()
    take: str = "first"


PLAIN = Cells()
FILLED = Cells(
    name=("Name", "Công ty", "name"), shown=("Name", "Công ty"), email=("Email", "Category", "Liên Hệ mail"), phone=("Phone", "SĐT"),
    site=("Website", "Công ty", "Liên Hệ"), link=("Website", "Liên Hệ"), address=("Address", "Địa chỉ"), category=("Category", "category"), take="filled",
)
ONE_SITE = replace(FILLED, site=("Website",))
BROKERS = replace(FILLED, shown=("Name", "Công ty", "name"), link=("Website", "Công ty", "Liên Hệ"), address=("Address", "Địa chỉ", "address"))
REGISTRY = Cells(
    name=("Tên công ty", "Tên tiếng Anh"), shown=("Tên công ty", "Tên tiếng Anh"), phone=("Điện thoại",), site=("Link chi tiết",), link=("Link chi tiết",), address=(),
    category=(), take="present",
)
MEMBERS = Cells(
    name=("name", "Name", "Công ty"), shown=("name", "Name", "Công ty"), email=("email", "Email"), phone=("phone", "Phone", "SĐT"), site=("website", "Website"),
    link=("website", "Website", "Liên Hệ"), address=("address", "Address", "Địa chỉ"), category=(), take="filled",
)
JOBS = Cells(
    name=("Tên chủ sử dụng",), shown=("Tên chủ sử dụng",), email=("Email liên hệ",), phone=("SĐT chủ",), site=("Link chi tiết",), link=("Link chi tiết",),
    address=("Địa điểm làm việc",), category=("Ngành nghề",), pay=("Điều kiện lao động (Lương/Ăn ở)",), until=("Ngày hết hạn",), broker=("SĐT môi giới",), tier=("Xếp loại Lead",),
)


@dataclass(frozen=True)
class Formatting:
    """How the template is filled: phone and name rules, e-mail rules, columns, ranking, translations, extra columns.

    shows: phones as `kept` (an apostrophe unless there is one), `quoted` (exactly one), `digits` (the key after one), or as `jobs` has
    them (digits, unless hidden; rows clash by the broker's phone where the own one is missing).
    """

    phone: str
    rules: Rules = Rules()
    cells: Cells = PLAIN
    shows: str = "kept"
    names: str = "ascii"
    closed: bool = True
    rank: tuple[str, ...] = ("Reviews_Count", "Rating")  # after an e-mail and a site
    table: dict[str, str] = field(default_factory=dict)
    lookup: str = "exact"  # exact, lower, first, constant (the default) or none (the cell as it is)
    default: str | None = None
    suffix: str = ""
    category: bool = True
    latin: bool = False


CLEANING = {
    "au_nails": Cleaning(), "nz_nails": Cleaning(), "au_cars": Cleaning(tuple(AU_CARS), contains=True), "au_barbers": Cleaning(("barber shop",)),
    "nz_barbers": Cleaning(("barber shop",)), "gr_brokers": Cleaning(tuple(GR_BROKERS), contains=True, blank=False),
    "au_builders": Cleaning(tuple(AU_BUILDERS), contains=True), "lv_builders": Cleaning(tuple(LV_BUILDERS)), "nz_farms": Cleaning(NZ_FARMS),
    "lv_fish": Cleaning(tuple(k for k in LV_FISH if k != "ražotājs"), contains=True), "gr_hotels": Cleaning(tuple(GR_HOTELS), contains=True),
    "pt_hotels": Cleaning(tuple(PT_HOTELS), contains=True), "lv_metal": Cleaning(tuple(LV_METAL), contains=True),
    "sk_agencies": Cleaning(tuple(SK_AGENCIES), lower=False), "sk_factories": Cleaning(tuple(SK_FACTORIES), lower=False),
    "tw_builders": Cleaning(tuple(TW_BUILDERS), lower=False), "tw_factories": Cleaning(tuple(TW_FACTORIES), lower=False),
    "lv_wood": Cleaning(tuple(LV_WOOD), contains=True),
}

FORMATTING = {
    "nz_nails": Formatting("nz", category=False),
    "au_barbers": Formatting("au", lookup="none"),
    "nz_barbers": Formatting("nz", lookup="none"),
    "nz_farms": Formatting("nz", lookup="none"),
    "au_cars": Formatting(
        "au_bare", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "repair", "auto", "car")),
        FILLED, "quoted", table=AU_CARS, lookup="lower", default="Gara sửa chữa ô tô", latin=True,
    ),
    "au_builders": Formatting(
        "au_bare", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "build", "builder", "construction")),
        FILLED, "quoted", table=AU_BUILDERS, lookup="lower",
    ),
    "gr_brokers": Formatting(
        "gr", Rules.broker(("info", "contact", "office", "admin", "hello", "sales", "manager", "service", "enquiries", "recruitment", "hr", "jobs", "careers")),
        BROKERS, "digits", "greek", table=GR_BROKERS, lookup="lower", default="Môi giới lao động Hy Lạp", latin=True,
    ),
    "gr_hotels": Formatting(
        "gr", Rules.registry(("info", "reservations", "reception", "contact", "office", "admin", "hello", "booking", "sales", "manager", "service", "enquiries")),
        FILLED, "digits", "greek", table=GR_HOTELS, lookup="lower", default="Khách sạn", suffix=" Hy Lạp",
    ),
    "gr_farms": Formatting(
        "gr", Rules.registry(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "farm", "agri", "fish", "forest")),
        REGISTRY, "digits", "greek", False, (), lookup="constant", default="Nông lâm thủy sản Hy Lạp",
    ),
    "gr_builders": Formatting(
        "gr", Rules.registry(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "build", "builder", "construction")),
        REGISTRY, "digits", "greek", False, (), lookup="constant", default="Xây dựng Hy Lạp",
    ),
    "gr_makers": Formatting(
        "gr", Rules.registry(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "factory", "manufacture", "production")),
        REGISTRY, "digits", "greek", False, (), lookup="constant", default="Sản xuất Hy Lạp",
    ),
    "lv_builders": Formatting(
        "lv", Rules(("info", "hello", "contact", "birojs", "office", "admin", "sales", "recepts", "enquiries", "manager", "buve")),
        FILLED, "digits", table=LV_BUILDERS, lookup="lower",
    ),
    "lv_fish": Formatting(
        "lv", Rules(("info", "hello", "contact", "birojs", "office", "admin", "sales", "recepts", "enquiries", "manager", "zivis", "zivju", "fish")),
        FILLED, "digits", table=LV_FISH, lookup="lower",
    ),
    "lv_metal": Formatting(
        "lv", Rules(("info", "hello", "contact", "office", "admin", "sales", "manager", "support", "mail", "enquiries"), ("wix", "no-reply", "noreply", "test", "example", "domain")),
        ONE_SITE, "digits", rank=("Reviews_Count",), table=LV_METAL, lookup="first", default="Gia công kim loại Latvia",
    ),
    "lv_wood": Formatting(
        "lv", Rules(("info", "hello", "contact", "office", "admin", "sales", "manager", "support", "mail", "enquiries", "birojs"), ("wix", "no-reply", "noreply", "test", "example", "domain")),
        ONE_SITE, "digits", rank=("Reviews_Count",), table=LV_WOOD, lookup="first", default="Gia công gỗ Latvia",
    ),
    "lv_metal_members": Formatting(
        "lv", Rules(("info", "hello", "contact", "office", "admin", "sales", "manager", "support", "mail", "enquiries"), ("wix", "no-reply", "noreply", "test", "example", "domain")),
        MEMBERS, "digits", closed=False, rank=(), lookup="constant", default="Hiệp hội Cơ khí - Gia công kim loại Latvia (MASOC)",
    ),
    "pt_hotels": Formatting(
        "pt", Rules(("info", "reservas", "reservations", "recepcao", "reception", "contacto", "contact", "geral", "general", "booking", "admin", "office")),
        FILLED, "quoted", table=PT_HOTELS, lookup="lower",
    ),
    "sk_agencies": Formatting(
        "sk", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "sk", "slovakia", "recruitment", "jobs")),
        PLAIN, "digits", "compact", table=SK_AGENCIES,
    ),
    "sk_factories": Formatting(
        "sk", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "sk", "slovakia", "factory", "mfg", "sklad")),
        PLAIN, "digits", "compact", table=SK_FACTORIES,
    ),
    "tw_builders": Formatting(
        "tw", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "tw", "taiwan", "build")),
        PLAIN, "digits", "compact", table=TW_BUILDERS,
    ),
    "tw_factories": Formatting(
        "tw", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "tw", "taiwan", "factory", "mfg")),
        PLAIN, "digits", "compact", table=TW_FACTORIES,
    ),
    "tw_jobs": Formatting(
        "tw", Rules(("info", "hello", "contact", "office", "admin", "sales", "enquiries", "manager", "service", "tw", "taiwan", "hr")),
        JOBS, "jobs", "compact", False, ("Số lượng tuyển (Quota)",), TW_JOBS, default="COLD LEAD ❄️",
    ),
}

#: Radius in km and zoom of the location grids.
GRIDS = {"au": (4.5, 13), "gr": (10.0, 11), "lv": (7.0, 11), "nz": (20.0, 11), "pt": (10.0, 11), "sk": (10.0, 11), "tw": (10.0, 11)}


@dataclass(frozen=True)
class Listing:
    """A search: its keywords, the country it names (after the place and, if `state`, the state), the language, and the category check.

    place is the key of the country's address rules; the check is as in Cleaning, without categories there is none.
    """

    keywords: tuple[str, ...]
    country: str
    language: str
    place: str
    state: bool = False
    categories: tuple[str, ...] = ()
    contains: bool = True
    lower: bool = True
    blank: bool = True


LISTINGS = {
    "au_nails": Listing(("nail salon",), "Australia", "en", "au", state=True),
    "nz_nails": Listing(("nail salon",), "New Zealand", "en", "nz"),
    "au_cars": Listing(
        ("Auto repair shop", "Car repair and maintenance service", "Automobile manufacturer", "Car manufacturer"), "Australia", "en", "au_loose",
        categories=tuple(AU_CARS), blank=False,
    ),
    "au_barbers": Listing(("barber shop",), "Australia", "en", "au", state=True),
    "nz_barbers": Listing(("barber shop",), "New Zealand", "en", "nz"),
    "gr_brokers": Listing(
        ("Εταιρεία συμβουλευτικών υπηρεσιών ανθρώπινου δυναμικού", "Γραφείο εύρεσης προσωπικού", "Γραφείο απασχόλησης"), "Greece", "el", "gr",
        categories=tuple(GR_BROKERS), blank=False,
    ),
    "au_builders": Listing(
        ("Contractor", "Construction company", "Home builder", "Office refurbishment service", "Excavating contractor", "Custom home builder"),
        "Australia", "en", "au_loose", categories=tuple(AU_BUILDERS),
    ),
    "lv_builders": Listing(
        ("Celtniecības uzņēmums", "Demontāžas darbuzņēmējs", "Betonēšanas pakalpojumu sniedzējs", "Ceļu būves uzņēmums", "Būvuzņēmums"), "Latvia", "lv", "lv"
    ),
    "nz_farms": Listing(
        ("Farm", "Orchard", "Crop grower", "Agricultural production", "Organic farm", "Vineyard", "Greenhouse", "Plant nursery", "Tree farm",
         "Truck farmer", "Pick your own farm produce", "Dairy farm", "Cattle farm", "Livestock producer", "Pig farm", "Poultry farm", "Honey farm",
         "Horsestable studfarm", "Christmas tree farm", "Orchid farm", "Orchid grower", "Aquaculture farm", "Fish farm", "Seafood farm", "Shrimp farm"),
        "New Zealand", "en", "nz",
    ),
    "lv_fish": Listing(
        ("Zivju apstrādes uzņēmums", "Konservu fabrika", "Zivju ferma", "Akvakultūras ferma", "Jūras velšu vairumtirgotājs"), "Latvia", "lv", "lv",
        categories=("zivju apstrādes uzņēmums", "konservu fabrika", "zivju ferma", "akvakultūras ferma", "jūras velšu vairumtirgotājs"),
    ),
    "gr_hotels": Listing(
        ("Ξενοδοχείο 5 αστέρων", "Κατ' οίκον φιλοξενία", "Ξενοδοχείο", "Ξενοδοχείο 4 αστέρων", "Ξενοδοχείο 3 αστέρων", "Ξενοδοχείο 2 αστέρων",
         "Ξενοδοχείο 1 αστέρων", "Ξενοδοχείο παρατεταμένης διαμονής", "Χόστελ", "Μοτέλ"),
        "Greece", "el", "gr", categories=tuple(GR_HOTELS),
    ),
    "pt_hotels": Listing(
        ("Hospedaria", "Hotel de 3 estrelas", "Hotel", "Hotel de 5 estrelas", "Hotel de 4 estrelas", "Hotel Resort", "Hospedagem domiciliar",
         "Hotel de 2 estrelas", "Albergue"),
        "Portugal", "pt", "pt", categories=tuple(PT_HOTELS),
    ),
    "lv_metal": Listing(
        ("Metāla darbnīca", "Metālapstrāde", "Metāla konstrukcijas", "Metāla izstrādājumu ražotājs", "Metāllūžņu sniedzējs"), "Latvia", "lv", "lv",
        categories=tuple(LV_METAL),
    ),
    "sk_agencies": Listing(
        ("Pracovná agentúra", "Personálne poradenstvo", "Agentúra pre sprostredkovanie práce", "Sprostredkovanie práce"), "Slovakia", "sk", "sk",
        categories=tuple(SK_AGENCIES), contains=False, lower=False, blank=False,
    ),
    "sk_factories": Listing(
        ("Strojná dielňa", "Výrobca autodielov", "Výrobca", "Dodávateľ železobetónových konštrukcií", "Chemický závod", "Továreň na automobily",
         "Továreň na čokoládu", "Továreň na topánky", "Výrobca elektroniky", "Kovovýroba", "Dodávateľ výrobkov z plastu",
         "Spoločnosť vyrábajúca plastové diely", "Služby vstrekovania plastov", "Dodávateľ výrobkov z gumy", "Výrobca batérií", "Sklad",
         "Prenájom skladovacích priestorov"),
        "Slovakia", "sk", "sk", categories=tuple(SK_FACTORIES), contains=False, lower=False, blank=False,
    ),
    "tw_builders": Listing(
        ("建築公司", "房屋建造商", "工程外判商", "承包商", "自訂房屋建築商", "土木工程公司", "建築修復服務"), "Taiwan", "zh-TW", "tw",
        categories=tuple(TW_BUILDERS), contains=False, lower=False, blank=False,
    ),
    "tw_factories": Listing(
        ("工廠設備供應商", "家具製造商", "電子產品製造商", "電子零件供應商", "玩具製造商", "食品製造商", "食品調味料製造商", "冷凍食品製造商", "化學工廠", "化學品製造商",
         "機械製造商", "機械廠", "機械零件製造商", "汽車零件製造商", "塑料製造公司", "塑膠製品供應商", "紡織廠", "紗廠", "服裝與布料製造商", "布產品製造商", "電池製造商",
         "玻璃製造商", "玻璃纖維供應商", "鞋廠", "汽車工廠", "造紙廠", "半導體供應商", "橡膠製品供應商", "扣件供應商", "製造商", "電子公司"),
        "Taiwan", "zh-TW", "tw", categories=tuple(TW_FACTORIES), contains=False, lower=False, blank=False,
    ),
    "lv_wood": Listing(
        ("Galdniecība", "Mēbeļu izgatavotājs", "Galdnieks", "Kokmateriālu piegādātājs", "Kokzāģētava"), "Latvia", "lv", "lv",
        categories=tuple(LV_WOOD),
    ),
}
#: Address of a search: keyword, coordinates, zoom and language stand in it.
SEARCH_URL = "https://www.google.com/maps/search/"
