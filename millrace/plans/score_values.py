"""The numbers and names that the SQL is written with.

They are stated here a second time, apart from the operators, so that a slip in one of the two shows.
"""

from __future__ import annotations

BUCKETS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Weight of each feature.
WEIGHTS = {
    "device": "0.1",
    "search": "0.15",
    "time": "0.1",
    "amount": "0.15",
    "brand": "0.2",
    "category": "0.3",
}

# Six numbers per label, in the order of the buckets.
DEVICE = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
SEARCH = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}
SEARCH_OTHER = (0, 0, 0, 0, 0, 0)
TIME = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
AMOUNT = {
    "低消费": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "中消费": (0.2, 0.4, 0.6, 0.7, 0.8, 0.7),
    "高消费": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
}
AMOUNT_MIDDLE_FROM, AMOUNT_HIGH_FROM = 1000, 4000
BRAND = {
    "A": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "B": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "C": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "D": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_OTHER = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
# Members of each group.
BRAND_GROUPS = {
    "A": ["TCL"],
    "B": ["苹果", "联想", "小米"],
    "C": ["欧莱雅"],
    "D": ["香奈儿"],
}
CATEGORY = {
    "1": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "2": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
}
CATEGORY_OTHER = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)
# Members of each group.
CATEGORY_GROUPS = {
    "1": ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"],
    "2": ["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"],
}

# Sign and its last day as month * 100 + day; later days fall back to the first sign.
ZODIAC = [
    ("摩羯座", 119),
    ("水瓶座", 218),
    ("双鱼座", 320),
    ("白羊座", 419),
    ("金牛座", 520),
    ("双子座", 621),
    ("巨蟹座", 722),
    ("狮子座", 822),
    ("处女座", 922),
    ("天秤座", 1023),
    ("天蝎座", 1122),
    ("射手座", 1221),
]

# Slot name and the first hour that no longer belongs to it.
TIME_SLOTS = [
    ("凌晨", 6),
    ("早晨", 9),
    ("上午", 12),
    ("中午", 14),
    ("下午", 18),
    ("晚上", 22),
    ("夜间", 24),
]
