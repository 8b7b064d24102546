"""Column names, word lists, lookup tables and thresholds.

Everything here is data that results depend on. No logic lives in this file.
"""

# --- Column names used by default ------------------------------------------------
LEAD_ID = "线索唯一ID"
PHONE = "手机号_脱敏"
CREATED = "线索创建时间"
FIRST_TOUCH = "首触时间"
ARRIVED = "到店时间"
DRIVEN = "试驾时间"
ORDERED = "下订时间"
RATING_RESULT = "线索评级结果"
RATING_BEFORE_DRIVE = "线索评级_试驾前"
CITY = "所在城市"
CAR = "首触意向车型"
FOLLOWUPS = "非首触跟进记录"
FOLLOWUPS_TECHNICAL = "跟进详情_JSON"
PREDICTED = "预测标签"
REQUIRED_COLUMNS = [CREATED, LEAD_ID]

# --- Fixed values: the headerless lead export, 46 fields in file order ------------
LEAD_EXPORT_COLUMNS = [
    "线索唯一ID", "客户ID", "客户ID_店端", "手机号_脱敏", "线索创建时间",
    "一级渠道名称", "二级渠道名称", "三级渠道名称", "四级渠道名称", "线索类型",
    "客户性别", "所在城市", "首触意向车型", "预算区间", "分配时间",
    "线索下发时间", "通话次数", "通话总时长", "平均通话时长", "最后一次通话距今天数",
    "首触时间", "首触线索是否及时外呼", "首触线索当天是否联通实体卡外呼",
    "通话时长是否大于等于45秒", "是否接通", "首触跟进记录", "首触线索评级",
    "非首触跟进时间", "非首触跟进记录", "线索评级变化时间", "线索评级结果",
    "客户是否主动询问交车时间", "客户是否主动询问购车权益", "客户是否主动询问金融政策",
    "客户是否同意加微信", "客户是否表示门店距离太远拒绝到店", "到店时间", "到店经销商ID",
    "试驾时间", "下订时间", "战败原因", "SOP开口标签", "意向金支付状态",
    "历史订单次数", "历史到店次数", "历史试驾次数",
]
LEAD_EXPORT_MARK = "DIS"
UNNAMED_PREFIX = "_未命名列_"

# --- Fixed values: the behaviour log, 11 fields in file order ---------------------
BEHAVIOR_COLUMNS = [
    "dmp_手机号", "dmp_事件时间", "dmp_事件名称", "dmp_车型代码", "dmp_品牌",
    "dmp_页面路径", "dmp_数值", "dmp_渠道", "dmp_分类", "dmp_未知", "dmp_平台",
]
BEHAVIOR_PHONE, BEHAVIOR_TIME, BEHAVIOR_EVENT = BEHAVIOR_COLUMNS[:3]
BEHAVIOR_FEATURES = [
    "dmp_行为次数", "dmp_最近行为时间", "dmp_试驾相关次数", "dmp_下单支付次数", "dmp_事件类型数",
]
DRIVE_EVENT_WORDS = ["testDrive", "试驾"]
ORDER_EVENT_WORDS = ["submitOrder", "payOrder", "下单", "支付"]

# --- Fixed values: alias contract (alias -> canonical name), version v2 -----------
CONTRACT_VERSION = "v2"
ALIASES = {
    "客户ID_店端_备用": "客户ID_店端",
    "客户ID(店端)": "客户ID_店端",
    "手机号（脱敏）": "手机号_脱敏",
    "线索类型_备用": "线索类型",
    "客户性别_备用": "客户性别",
    "预算区间_备用": "预算区间",
    "预算区间(购车预算)": "预算区间",
    "首触意向车型/意向车型": "首触意向车型",
    "通话时长是否>=45秒": "通话时长是否大于等于45秒",
    "客户是否主动询问购车权益（优惠）": "客户是否主动询问购车权益",
    "跟进记录_JSON": "首触跟进记录",
    "跟进详情_JSON": "非首触跟进记录",
    "首触跟进记录_备用": "首触跟进记录",
    "非首触跟进时间_备用": "非首触跟进时间",
    "非首触跟进时间_备用2": "非首触跟进时间",
    "线索评级变化时间_备用": "线索评级变化时间",
    "到店经销商ID_备用": "到店经销商ID",
    "到店日期_备用": "试驾时间",
    "SOP开口标签_备用": "SOP开口标签",
    "意向金支付状态_备用": "意向金支付状态",
    "历史订单次数_备用": "历史订单次数",
    "历史到店次数_备用": "历史到店次数",
    "历史试驾次数_备用": "历史试驾次数",
    "线索评级结果（最新）": "线索评级结果_最新",
    "行业标签分析结果（JSON）": "行业标签分析结果_JSON",
}
EXACT_NAMES = {
    "线索评级结果（最新）": "线索评级结果_最新",
    "行业标签分析结果（JSON）": "行业标签分析结果_JSON",
    "手机号（脱敏）": "手机号_脱敏",
    "客户是否主动询问购车权益（优惠）": "客户是否主动询问购车权益",
    "客户ID(店端)": "客户ID_店端",
    "预算区间(购车预算)": "预算区间",
    "首触意向车型/意向车型": "首触意向车型",
}

# --- Fixed values: column roles ---------------------------------------------------
ID_COLUMNS = [
    "线索唯一ID", "客户ID", "客户ID_店端", "手机号_脱敏", "手机号码", "主键",
    "店端潜客编号", "split_group_key", "经销店代码", "到店经销商ID",
]
LEAKAGE_COLUMNS = [
    "是否到店", "是否试驾", "试驾天数差", "试驾时间", "到店时间", "下订时间", "下定状态",
    "意向金支付状态", "战败原因", "战败次数",
    "线索当前意向级别", "线索评级结果_最新", "线索评级结果", "线索评级变化时间",
    "线索评级变化时间_备用", "意向级别", "购车阶段", "线索评级_试驾前", "线索评级_试驾后",
    "线索评级结果_备用", "商机评级_试驾后", "latest_intn_level",
    "行业标签分析结果_JSON", "跟进记录_JSON", "跟进详情_JSON", "首触跟进记录", "非首触跟进记录",
    "关注点json", "希望试驾体验的功能json", "爱好json", "顾虑点json", "竞品车型及试驾json", "备忘",
    "提及试驾", "提及到店", "最终战败", "意向级别下降",
    "最后一次通话距今天数", "defeat_reason_content",
    "订单状态", "成交日期", "结算日期", "订单号", "customer_order_no", "意向金支付状态_备用",
    "label_7天内试驾", "label_14天内试驾", "label_21天内试驾", "label_OHAB",
    "到店标签_7天", "到店标签_14天", "到店标签_30天",
    "试驾标签_7天", "试驾标签_14天", "试驾标签_21天", "试驾标签_30天",
    "下订标签_7天", "下订标签_14天", "下订标签_21天",
    "成交标签", "is_final_ordered", "试驾后下订天数差",
]
LABEL_GROUPS = [
    ["试驾标签_7天", "试驾标签_14天", "试驾标签_21天", "试驾标签_30天"],
    ["到店标签_7天", "到店标签_14天", "到店标签_30天"],
    ["下订标签_7天", "下订标签_14天", "下订标签_21天"],
    ["label_OHAB", "线索评级结果"],
]
ORDER_STAGE_LEAKAGE = [
    "下定状态", "意向金支付状态", "战败原因", "战败次数", "线索当前意向级别",
    "线索评级结果（最新）", "线索评级变化时间", "意向级别", "购车阶段",
    "线索评级结果", "线索评级_试驾前", "线索评级_试驾后",
]
ORDER_STAGE_IDS = [
    "线索唯一ID", "客户ID", "客户ID(店端)", "店端潜客编号", "手机号码", "手机号（脱敏）", "主键",
]
TIME_COLUMNS = ["线索创建时间", "分配时间", "线索下发时间", "首触时间", "客户建档时间"]
NUMERIC_COLUMNS = [
    "通话次数", "通话总时长", "平均通话时长", "平均通话时长_派生", "通话时长是否大于等于45秒",
    "是否接通", "首触线索是否及时外呼", "首触线索当天是否联通实体卡外呼",
    "历史订单次数", "历史到店次数", "历史试驾次数",
    "线索创建星期几", "线索创建小时",
    "跟进总次数", "接通次数", "未接通次数", "接通率", "继续跟进次数",
    "平均通话时长_秒", "最长通话时长_秒",
    "首触响应时长_小时", "城市车型热度", "有效通话", "AI语义标签可用", "语义标签命中数",
    "JSON跟进明细可用", "跟进次数",
]
SEMANTIC_COLUMNS = [
    "客户是否主动询问交车时间", "客户是否主动询问购车权益", "客户是否主动询问金融政策",
    "客户是否同意加微信", "客户是否表示门店距离太远拒绝到店",
]
WEAK_COLUMNS = ["跟进时间_备用", "跟进内容_备用", "跟进结果_备用", "跟进备注_备用", "备用字段_43"]
INDICATOR_SUFFIX = "_缺失"
CLEANING_PROTECTED = ["线索唯一ID", "线索创建时间"]
LABEL_MARKERS = ["标签", "评级"]
TARGET_WORDS = ["评级", "标签", "结果", "level", "label", "target"]

# --- Fixed values: classes --------------------------------------------------------
OHAB_ORDER = ["O", "H", "A", "B"]
HAB_ORDER = ["H", "A", "B"]
RATING_ORDER = ["O", "H", "A", "B", "C", "N"]
UNKNOWN = "未知"
UNKNOWN_LABEL = "Unknown"
NOT_H = "非H"
OUTCOME_COLUMNS = [
    "到店标签_7天", "到店标签_14天", "到店标签_30天",
    "试驾标签_7天", "试驾标签_14天", "试驾标签_30天", "is_final_ordered",
]

# --- Fixed values: status words ---------------------------------------------------
BOOKING_STATUS_WORDS = ["已下定", "已成交", "已订车", "成交", "订车", "已下单"]
ORDER_STATUS_WORDS = ["已下定", "已成交", "已订车", "成交", "订车", "已完成", "已下单"]
PAID_WORDS = ["已支付", "已付", "支付成功"]
ORDER_EVIDENCE_COLUMNS = ["下订时间", "成交日期", "结算日期", "订单号", "customer_order_no"]
ORDER_FLAG_COLUMNS = ["成交标签", "is_final_ordered"]
DRIVEN_WORDS = ["已试驾", "试驾完成", "完成试驾"]
PHONE_COLUMNS = ["手机号", "手机号_脱敏", "客户手机", "phone"]
EMPTY_PHONE = "00000000000"
DEFEAT_WORDS = [
    "已购买竞品", "购买竞品", "已购车", "购买其他品牌", "明确拒绝", "拒绝跟进", "无意向", "无购车意向",
    "放弃购车", "不考虑", "已取消", "无效线索", "竞品", "已在别处购买", "流失",
]
INVALID_RATINGS = ["N", "无效", "战败", "流失"]
INVALID_CUSTOMER_WORDS = ["无效", "战败", "流失", "已购车", "放弃"]
INVALID_TYPE_WORDS = ["无效", "战败", "重复", "测试"]
TRUTHY_WORDS = ["1", "true", "True", "是", "有", "已支付", "支付成功", "已转定金"]

# --- Fixed values: follow-up records ----------------------------------------------
LEVEL_FIELD = "意向级别"
CALL_FIELD = "通话结果"
RESULT_FIELD = "跟进结果"
DURATION_FIELD = "通话时长(分:秒)"
MEMO_FIELD = "跟进备忘"
LEVEL_RANK = {"O": 4, "H": 3, "A": 2, "B": 1}
CONNECTED, NOT_CONNECTED, CONTINUED, DEFEATED = "已接通", "未接通", "继续", "战败"
PRICE_WORDS = ["价格", "优惠", "便宜", "多少钱", "打折", "降价", "折扣", "活动"]
DRIVE_WORD = "试驾"
STORE_WORDS = ["到店", "来店", "进店", "过去看", "去看车", "到展厅"]
COMPETITOR_WORDS = ["比亚迪", "特斯拉", "小鹏", "蔚来", "理想", "问界", "极氪", "小米汽车"]

# --- Fixed values: masking --------------------------------------------------------
BRAND_CODES = {
    "广汽丰田": "品牌A", "广汽本地": "区域A", "广丰": "品牌A",
    "广汽": "集团A", "GTMC": "代号G", "丰田": "品牌B",
}
CAR_CODES = {
    "铂智3X": "车型A", "铂智4X": "车型B", "铂智": "车型X", "雷凌": "车型C", "凯美瑞": "车型D",
    "汉兰达": "车型E", "赛那": "车型F", "威兰达": "车型G", "锋兰达": "车型H", "威飒": "车型I",
    "C-HR": "车型J", "YARiS L": "车型K", "致炫": "车型L", "致享": "车型M", "iA5": "车型N",
    "bZ4X": "车型O",
}
BRAND_COLUMNS = [
    "首触意向车型/意向车型", "首触意向车型", "意向车型", "一级渠道名称", "二级渠道名称", "三级渠道名称",
    "四级渠道名称", "首触渠道json", "首触跟进记录", "非首触跟进记录", "战败原因", "dmp_品牌",
    "dmp_车型代码", "竞品车型及试驾json", "备忘", "关注点json", "顾虑点json", "希望试驾体验的功能json",
]
CAR_COLUMNS = [
    "首触意向车型/意向车型", "首触意向车型", "意向车型", "首触跟进记录", "非首触跟进记录",
    "竞品车型及试驾json", "三级渠道名称", "四级渠道名称", "备忘", "关注点json", "顾虑点json",
]
BRAND_NAME_WORDS = [
    "车型", "渠道", "跟进", "战败", "品牌", "dmp_", "标签", "JSON", "json", "销售", "经销", "店",
]
CAR_NAME_WORDS = ["车型", "意向"]
ID_MASK_NAME_WORD = "客户ID"
PHONE_NAME_WORDS = ["手机", "phone"]
PHONE_TEXT_NAME_WORDS = ["跟进", "战败", "记录"]
ID_CARD_NAME_WORDS = ["身份证", "证件"]
CITY_COLUMNS = ["所在城市", "市名称"]
PROVINCE_COLUMNS = ["省份名称"]
CITY_PREFIX, PROVINCE_PREFIX = "城市", "省份"
DEALER_COLUMNS = ["经销店代码"]
PLATE_PATTERN = "[京津沪渝冀豫云辽黑湘皖鲁新苏浙赣鄂桂甘晋蒙陕吉闽贵粤青藏川宁琼使领][A-Z][A-Z0-9]{5,6}"
PLATE_MASK = "车牌***"
PHONE_PATTERN = "1[3-9][0-9]{9}"
PHONE_PARTS_PATTERN = "(1[3-9][0-9])([0-9]{4})([0-9]{4})"
PHONE_FULL_MASK = "手机***********"
ID_CARD_PATTERN = r"(?=\d{15})(\d{6})[\dXx]{5,8}([\dXx]{4})"

# --- Fixed values: response bands (upper edge in hours, right-closed) -------------
RESPONSE_BANDS = [(0.0, "未知"), (1.0, "即时"), (4.0, "快速"), (24.0, "正常")]
RESPONSE_LAST_BAND = "延迟"
RESPONSE_OUTSIDE = "nan"

# --- Fixed values: rating scores --------------------------------------------------
SCORE_WEIGHT_7, SCORE_WEIGHT_14, SCORE_WEIGHT_21 = 100.0, 60.0, 30.0
STAGE_ORDERED, STAGE_INVALID, STAGE_BEFORE, STAGE_AFTER = "O", "无效", "试驾前", "试驾后"
HAB_TEXT = {
    "H": "高意向，7天内计划试驾",
    "A": "中意向，14天内计划试驾",
    "B": "低意向，21天内计划试驾",
    "N": "无意向，暂无试驾计划",
}
NEXT_CONTACT_DAYS = {"H": 3, "A": 7, "B": 14}
NEXT_CONTACT_DAYS_ORDER_STAGE = {"H": 2, "A": 5, "B": 7}

# --- Fixed values: scorecard ------------------------------------------------------
SCORECARD = {
    "基础特征": (0.20, ["一级渠道名称", "二级渠道名称", "三级渠道名称", "四级渠道名称", "所在城市",
                    "首触意向车型", "预算区间", "线索类型"]),
    "画像特征": (0.10, ["客户性别", "历史订单次数", "历史到店次数", "历史试驾次数"]),
    "行为特征": (0.25, ["通话次数", "通话总时长", "平均通话时长_派生", "是否接通", "有效通话",
                    "跟进总次数", "接通次数"]),
    "时序特征": (0.20, ["首触响应时长_小时", "首触线索是否及时外呼", "响应及时性",
                    "首触线索当天是否联通实体卡外呼"]),
    "意图特征": (0.25, ["客户是否主动询问交车时间", "客户是否主动询问购车权益", "客户是否主动询问金融政策",
                    "客户是否同意加微信", "提及价格", "提及试驾", "提及到店"]),
}
CHANNEL_COLUMNS = ["一级渠道名称", "二级渠道名称", "三级渠道名称", "四级渠道名称"]

# --- Fixed values: reason phrases, in order ---------------------------------------
REASON_PHRASES = {
    "提及试驾": "客户在跟进中主动提及试驾，处于较强体验决策阶段。",
    "提及到店": "客户已表现出到店意向，具备线下转化基础。",
    "提及价格": "客户开始关注价格和权益，已进入比价决策阶段。",
    "客户是否主动询问金融政策": "客户主动询问金融政策，说明在评估支付方案。",
    "客户是否主动询问交车时间": "客户主动关注交车时间，存在较明确的购车时间预期。",
    "客户是否同意加微信": "客户愿意添加微信，便于持续私域跟进。",
    "有效通话": "存在有效通话，销售与客户已发生实质沟通。",
    "接通率": "历史接通率较高，客户触达效率较好。",
    "首触响应时长_小时": "首触响应较快，销售及时介入了窗口期。",
    "历史到店次数": "客户历史上有到店记录，对品牌已有实际接触。",
    "历史试驾次数": "客户历史上已有试驾行为，成交基础相对更好。",
    "客户是否表示门店距离太远拒绝到店": "客户表达过门店距离顾虑，到店转化阻力较大。",
    "最终战败": "历史跟进中出现战败信号，短期转化意愿偏弱。",
    "意向级别下降": "跟进过程中意向级别出现下降，需谨慎投入高强度资源。",
    "未接通次数": "未接通次数偏多，当前客户触达稳定性不足。",
    "通话次数": "虽然发生过外呼，但有效沟通深度仍然不足。",
}
REASON_FIRST_WORDS = {"H": ["主动", "有效通话", "到店", "试驾"], "B": ["阻力", "下降", "不足", "战败"]}
REASON_FALLBACK = {
    "H": "近期互动质量和意向信号整体较强，建议优先转化。",
    "A": "客户有一定兴趣，但仍处于比较和考虑阶段。",
    "B": "当前显性高意向信号不足，适合进入培育节奏。",
}
REASON_FALLBACK_OTHER = "当前业务信号有限，建议按标准流程跟进。"
SOP_TEXT = {
    "H": "24小时内优先跟进，优先邀约试驾/到店，明确车型、权益和到店时间。",
    "A": "48小时内完成跟进，重点沟通优惠权益、金融方案和顾虑消除。",
    "B": "进入培育节奏，按周触达，优先用内容运营或自动化私域继续激活。",
}
SOP_OTHER = "按标准销售节奏跟进。"
LEVEL_NAME = {"H": "高意向", "A": "中高意向", "B": "待培育"}

# --- Fixed values: business dimension of a feature --------------------------------
DIMENSIONS = {
    "基础特征": ["一级渠道名称", "二级渠道名称", "三级渠道名称", "四级渠道名称", "所在城市",
             "首触意向车型", "预算区间", "线索类型", "渠道组合", "城市车型热度"],
    "画像特征": ["客户性别", "历史订单次数", "历史到店次数", "历史试驾次数", "历史订单次数_备用",
             "历史到店次数_备用"],
    "行为特征": ["通话次数", "通话总时长", "平均通话时长", "通话时长是否大于等于45秒",
             "平均通话时长_派生", "是否接通", "客户是否同意加微信", "意向金支付状态",
             "意向金支付状态_备用", "跟进总次数", "接通次数", "未接通次数", "接通率", "继续跟进次数",
             "平均通话时长_秒", "最长通话时长_秒", "有效通话", "AI语义标签可用", "语义标签命中数",
             "JSON跟进明细可用"],
    "时序特征": ["线索创建星期几", "线索创建小时", "线索创建时间_day_of_week", "线索创建时间_hour",
             "线索创建时间_is_weekend", "分配时间_day_of_week", "分配时间_hour", "分配时间_is_weekend",
             "线索下发时间_day_of_week", "线索下发时间_hour", "线索下发时间_is_weekend",
             "首触时间_day_of_week", "首触时间_hour", "首触时间_is_weekend", "首触线索是否及时外呼",
             "首触线索当天是否联通实体卡外呼", "首触响应时长_小时", "响应及时性"],
    "意图特征": ["客户是否主动询问交车时间", "客户是否主动询问购车权益", "客户是否主动询问金融政策",
             "客户是否表示门店距离太远拒绝到店", "SOP开口标签", "SOP开口标签_备用", "提及价格",
             "提及试驾", "提及到店", "提及竞品", "意向级别下降", "最终战败"],
}
OTHER_DIMENSION = "其他特征"

# --- Fixed values: messages and grids ---------------------------------------------
LAYERED_BOTH = "已形成清晰分层效果"
LAYERED_ONE = "已形成初步分层效果，H/A 边界仍需二期优化"
LAYERED_NONE = "POC 已验证建模与 SOP 联动可行，分层边界仍需结合更多行为特征继续校准"
MONOTONIC_YES = "H/A/B 分层单调"
MONOTONIC_NO = "H/A/B 分层未形成单调"
MONOTONIC_MISSING = "缺少可用的行为验证指标"
REPORT_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5]
H_THRESHOLDS = [0.45, 0.50, 0.55, 0.60, 0.65]
B_THRESHOLDS = [0.20, 0.25, 0.30, 0.35, 0.40]
STAGE_H_THRESHOLDS = [0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65]
TOP_RATIOS = [0.05, 0.10, 0.20]
