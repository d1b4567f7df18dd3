"""Word lists, lookup tables and patterns whose values decide results.

FIXED VALUES: everything below must equal the values users already rely on, otherwise scores,
labels and counts change.  Edit a copy and pass it as a parameter; do not edit in place.
"""

# --- shared regular expressions (written for the common subset of java.util.regex and RE2) ---

# The characters Python's Unicode \s matches.
SPACE_CHARS = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
SPACES = f"[{SPACE_CHARS}]+"
# The same characters except the blank, by Unicode property: one fast test per character.
ODD_SPACE = r"[\p{IsWhite_Space}\x1c-\x1f&&[^ ]]"
URL = r"https?://(?:[a-zA-Z0-9]|[$-_@.&+]|[!*\\(),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
BRACKET_EMOJI = r"\[[^\n]*?\]"
HTML_TAG = r"<[^\n]*?>"
MENTION = f"@[^{SPACE_CHARS}]+"
# Exactly x00-x1f and x7f-x9f.
CONTROL_CHARS = r"\p{Cc}"
MENTION_TARGET = rf"(?:回复|@)[{SPACE_CHARS}]*([^:：{SPACE_CHARS}]+)"
VALID_NAME = "[一-龥a-zA-Z0-9]"
BOT_AVATAR = "default|placeholder|null"

# --- place names ---

UNKNOWN_PLACE = "未知"
OTHER_REGION = "其他地区"

# Tested in this order; the first hit wins, and a hit is a substring match without case.
COUNTRY_RULES = [
    ("中国", ["中国", "china", "cn"]),
    ("美国", ["美国", "usa", "america", "us"]),
    ("日本", ["日本", "japan", "jp"]),
    ("韩国", ["韩国", "korea", "kr"]),
    ("欧洲", ["欧洲", "europe", "eu"]),
    ("英国", ["英国", "uk", "united kingdom"]),
    ("加拿大", ["加拿大", "canada", "ca"]),
    ("澳大利亚", ["澳大利亚", "australia", "au"]),
    ("中国", ["北京", "上海", "广东", "深圳", "广州", "江苏", "浙江", "四川", "湖北", "湖南", "山东",
            "河南", "河北", "陕西", "福建", "安徽", "重庆", "天津", "辽宁", "吉林", "黑龙江", "内蒙古",
            "新疆", "西藏", "云南", "贵州", "广西", "海南", "江西", "山西", "甘肃", "青海", "宁夏"]),
]

PROVINCE_RULES = [
    ("北京", ["北京", "beijing"]),
    ("上海", ["上海", "shanghai"]),
    ("天津", ["天津", "tianjin"]),
    ("重庆", ["重庆", "chongqing"]),
    ("广东", ["广东", "guangdong", "广州", "guangzhou", "深圳", "shenzhen", "珠海", "zhuhai",
            "佛山", "foshan"]),
    ("江苏", ["江苏", "jiangsu", "南京", "nanjing", "苏州", "suzhou", "无锡", "wuxi"]),
    ("浙江", ["浙江", "zhejiang", "杭州", "hangzhou", "宁波", "ningbo", "温州", "wenzhou"]),
    ("四川", ["四川", "sichuan", "成都", "chengdu"]),
    ("湖北", ["湖北", "hubei", "武汉", "wuhan"]),
    ("湖南", ["湖南", "hunan", "长沙", "changsha"]),
    ("山东", ["山东", "shandong", "济南", "jinan", "青岛", "qingdao"]),
    ("河南", ["河南", "henan", "郑州", "zhengzhou"]),
    ("河北", ["河北", "hebei", "石家庄", "shijiazhuang"]),
    ("陕西", ["陕西", "shaanxi", "西安", "xian"]),
    ("福建", ["福建", "fujian", "厦门", "xiamen", "福州", "fuzhou"]),
    ("安徽", ["安徽", "anhui", "合肥", "hefei"]),
    ("辽宁", ["辽宁", "liaoning", "沈阳", "shenyang", "大连", "dalian"]),
    ("吉林", ["吉林", "jilin", "长春", "changchun"]),
    ("黑龙江", ["黑龙江", "heilongjiang", "哈尔滨", "harbin"]),
    ("云南", ["云南", "yunnan", "昆明", "kunming"]),
    ("贵州", ["贵州", "guizhou", "贵阳", "guiyang"]),
    ("广西", ["广西", "guangxi", "南宁", "nanning"]),
    ("海南", ["海南", "hainan", "海口", "haikou"]),
    ("江西", ["江西", "jiangxi", "南昌", "nanchang"]),
    ("山西", ["山西", "shanxi", "太原", "taiyuan"]),
    ("甘肃", ["甘肃", "gansu", "兰州", "lanzhou"]),
    ("青海", ["青海", "qinghai", "西宁", "xining"]),
    ("新疆", ["新疆", "xinjiang", "乌鲁木齐", "urumqi"]),
    ("西藏", ["西藏", "tibet", "拉萨", "lhasa"]),
    ("内蒙古", ["内蒙古", "inner mongolia", "呼和浩特", "hohhot"]),
    ("宁夏", ["宁夏", "ningxia", "银川", "yinchuan"]),
]

CITY_RULES = [
    ("北京", ["北京", "beijing"]),
    ("上海", ["上海", "shanghai"]),
    ("广州", ["广州", "guangzhou"]),
    ("深圳", ["深圳", "shenzhen"]),
    ("杭州", ["杭州", "hangzhou"]),
    ("成都", ["成都", "chengdu"]),
    ("武汉", ["武汉", "wuhan"]),
    ("西安", ["西安", "xian"]),
    ("南京", ["南京", "nanjing"]),
    ("苏州", ["苏州", "suzhou"]),
]

# --- sentiment lexicons ---

# Used while cleaning; a word listed n times weighs n.
CLEANING_POSITIVE = [
    "好", "喜欢", "赞", "棒", "优秀", "支持", "感谢", "厉害", "牛", "开心", "不错", "很好", "太好了", "完美", "满意", "推荐",
    "值得", "有用", "有帮助", "专业", "清晰", "易懂", "实用", "有效", "成功", "进步", "提升", "改善", "鼓励", "加油", "努力",
    "坚持", "希望", "期待", "相信", "肯定", "认可",
]
CLEANING_NEGATIVE = [
    "差", "讨厌", "垃圾", "不好", "失望", "反对", "恶心", "糟糕", "烦", "生气", "不行", "没用", "错误", "失败", "问题", "困难",
    "麻烦", "复杂", "困惑", "担心", "焦虑", "压力", "累", "难", "慢", "贵", "贵", "贵", "贵", "批评", "质疑", "怀疑", "不满",
    "抱怨", "遗憾", "可惜", "无奈", "无语",
]

# Used for regional heat and the daily trend.
TREND_POSITIVE = [
    "喜欢", "不错", "支持", "加油", "希望", "成功", "上岸", "机会", "发展", "利好", "优秀", "进步", "好", "棒", "赞", "开心",
    "快乐", "推荐", "收获", "丰富", "稳定", "高薪", "牛", "厉害", "期待", "拥有", "解决", "提升", "明确", "肯定",
]
TREND_NEGATIVE = [
    "焦虑", "担心", "害怕", "失业", "裁员", "迷茫", "垃圾", "恶心", "讨厌", "差", "难", "累", "卷", "痛苦", "失望", "后悔",
    "完蛋", "离谱", "无语", "压力", "甚至", "怀疑", "不行", "放弃", "淘汰", "危机", "没用", "骗子", "忽悠", "惨",
]

# Used to label training rows.
TRAINING_POSITIVE = [
    "喜欢", "不错", "支持", "加油", "希望", "成功", "上岸", "机会", "发展", "优秀", "好", "棒", "赞", "开心", "快乐",
]
TRAINING_NEGATIVE = [
    "焦虑", "担心", "害怕", "失业", "裁员", "迷茫", "垃圾", "恶心", "讨厌", "差", "难", "累", "卷", "痛苦", "失望",
]

SENTIMENT_LABELS = {"positive": "正面", "neutral": "中性", "negative": "负面"}

# --- noise, stop words, phrases ---

NOISE_FRAGMENTS = ["转发微博", "转发", "转", "...", "。。", "???", "!!!", "？？？", "！！！"]

STOP_WORDS = [
    "的", "了", "是", "在", "我", "有", "和", "就", "不", "人", "都", "一", "一个", "上", "也", "很", "到", "说", "要",
    "去", "你", "会", "着", "没有", "看", "好", "自己", "这",
]

CUSTOM_PHRASES = {
    "人工智能": "技术",
    "AI裁员": "社会事件",
    "就业焦虑": "情绪",
    "互联网寒冬": "社会事件",
    "大厂裁员": "社会事件",
}

TOPIC_NAMES = {
    0: "Topic A: 网友调侃/泛泛而谈",
    1: "Topic B: AI与人类未来/哲学",
    2: "Topic C: 就业焦虑/现状吐槽",
    3: "Topic D: 学生升学/职业规划",
}

# Right-closed length groups: (lower, upper, label).
LENGTH_GROUPS = [(0, 20, "短评 (<20字)"), (20, 60, "中评 (20-60字)"), (60, 1000, "长评 (>60字)")]

# --- codes that differ by platform ---

GENDER_CODES = {
    "xhs": ({"1": "女", "0": "男"}, None),
    "douyin": ({"0": "未知", "1": "男", "2": "女"}, "未知"),
    "weibo": ({"f": "女"}, "男"),
    "kuaishou": ({"F": "女"}, "男"),
    "zhihu": ({"1": "男", "0": "女"}, "未知"),
}

TRUE_WORDS = ["yes", "true", "t", "y", "1"]
FALSE_WORDS = ["no", "false", "f", "n", "0"]

IMAGE_MIRRORS = [
    "https://sns-img-qc.xhscdn.com",
    "https://sns-img-hw.xhscdn.com",
    "https://sns-img-bd.xhscdn.com",
    "https://sns-img-qn.xhscdn.com",
]

HTML_ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]

CLEANING_STEPS = ["drop_blank_rows", "standardise_types", "handle_missing", "clean_text",
                  "remove_duplicates", "add_features", "filter_noise"]
