"""Column names of the fitment tables."""

# Columns of the export and of the tables made from it.
BRAND = "Name"
MODEL = "VM"
TYPE = "TypeName"
ENGINES = "Engines"
POWER = "HorsePowers"
PERIOD = "Year"
CATEGORY = "GenericArticle"
ARTICLE = "ArticleNumber"
CRITERIA = "Criterias"
NOTE = "NEW_CRIT"
NOTE_LABEL = "VM_df2"

# Key columns of the report.
LABEL_COLUMN = "МОДЕЛЬ"
ENGINE_COLUMN = "КОД ДВИГАТЕЛЯ"
POWER_COLUMN = "Мощность Л.С"
REPORT_KEYS = [LABEL_COLUMN, ENGINE_COLUMN, POWER_COLUMN]

# The cabin filter column before and after its renaming.
CABIN_SOURCE = "Фильтр, воздух во внутренном пространстве"
CABIN = "Салонный фильтр"

# Cabin filter columns by article prefix, with the longer
# prefixes that a shorter one must not take.
CABIN_PREFIXES = {
    "Салонный фильтр CAC": ("CAC", ()),
    "Салонный фильтр CAB": ("CAB", ()),
    "Салонный фильтр CA": ("CA", ("CAC", "CAB")),
}

# List columns in the order in which they are spread.
SPREAD_COLUMNS = [
    "Радиатор, охлаждение двигателя",
    "Масляный фильтр",
    "Топливный фильтр",
    "Воздушный фильтр",
    "Спортивный воздушный фильтр",
    "Салонный фильтр CAC",
    "Салонный фильтр CAB",
    "Салонный фильтр CA",
]

# Category columns of the finished table, in output order.
CATEGORY_COLUMNS = [
    "Масляный фильтр",
    "Топливный фильтр",
    "Воздушный фильтр",
    "Спортивный воздушный фильтр",
    "Радиатор, охлаждение двигателя",
    "Конденсатор, кондиционер",
    "Интеркулер",
    "Гидрофильтр, автоматическая коробка передач",
    "Комплект гидрофильтров, автоматическая коробка передач",
    "Топливно-водяной сепаратор",
    "Фильтр охлаждающей жидкости",
    "Патрон осушителя воздуха, пневматическая система",
    "Салонный фильтр CAC",
    "Салонный фильтр CAB",
    "Салонный фильтр CA",
]
