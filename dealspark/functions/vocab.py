"""Vocabularies, patterns and formats of deal disclosures: fixed values of the record format.

All patterns are alternations without look-around, so that they mean the same in Spark and in other engines.
"""

#: Parties that name nobody.
VAGUE_PARTIES = (
    "未披露", "未知", "不详", "待定", "某标的", "标的资产", "标的公司", "相关资产", "部分资产", "旗下资产", "金融资产", "相关股权",
    "受让方", "转让方", "未具名", "控股子公司", "实施情况报告书", "相关事项", "交易对方", "交易各方", "本次交易", "本次收购",
)
#: Legal forms in reports and in weekly tables: two lists that differ.
REPORT_SUFFIXES = ("股份有限公司", "有限责任公司", "有限公司", "控股集团", "控股有限公司", "控股", "集团", "公司", "corporation", r"inc\.?", "limited", r"ltd\.?", "plc", "holdings?")
WEEKLY_SUFFIXES = ("股份有限公司", "有限责任公司", "有限公司", "控股集团", "控股有限公司", "集团股份", "集团", "公司", "corporation", r"inc\.?", "limited", r"ltd\.?", "plc", "holdings?")
#: What separates the parts of a name.
SEPARATORS = r"[\s·・,，.。:：;；/\\|&＋+_\-]+"
UNKNOWN_PARTIES = ("未披露", "未知", "不详", "某标的", "标的资产", "标的公司")
DEAL_VERBS = ("收购", "并购", "入主", "吸收合并", "私有化", "合并", "出售", "控股", "取得")
TITLE_VERBS = ("收购", "并购", "入主", "吸收合并", "私有化", "合并", "出售")
DOMESTIC = ("中国", "A股", "港股", "境内", "香港", "中概")

NUMBER = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"
VALUE_UNITS = "%|％|亿元|亿美元|亿港元|万港元|万元|美元|港元|元|股|股份|股权|crore|million|billion|bn|mn"
DEAL_NUMBER = rf"(?i){NUMBER}\s*(?:{VALUE_UNITS})?"
DEAL_VALUE = rf"(?i){NUMBER}\s*(?:{VALUE_UNITS})"
STRUCTURE = r"全部股权|全部股份|控股权|控制权|表决权|支付现金|现金支付|现金收购|发行股份(?:及支付现金)?|股份支付|定向发行|定增|全额认购|认购|协议转让|要约收购|收购报告书|权益变动报告书|股权转让|股份转让|受让.{0,20}(?:股权|股份)|非货币(?:出资|实缴)|作价出资"
#: (pattern, label) of the terms of a transaction, in order.
TERMS = (
    ("全部股权|全部股份", "全部股权/股份"), ("支付现金|现金支付|现金收购", "现金支付"), ("发行股份及支付现金", "发行股份及支付现金"), ("发行股份|股份支付", "股份支付"), ("协议转让", "协议转让"),
    ("股权转让|股份转让|受让.{0,20}(?:股权|股份)", "股权/股份受让"), ("要约收购", "要约收购"), ("定向发行|定增|全额认购|认购", "定向发行/认购"), ("非货币(?:出资|实缴)|作价出资", "非货币出资/作价出资"), ("控股权|控制权|表决权", "控制权/表决权安排"),
)

RICH_DISCLOSURE = ("要约收购报告书", "要约收购", "权益变动报告书", "详式权益变动", "收购报告书", "重大资产重组报告书", "重组报告书", "交易报告书", "草案", "预案", "发行股份及支付现金", "协议转让", "控制权变更", "完成过户", "结果公告")
DETAIL_DISCLOSURE = ("要约收购报告书", "权益变动报告书", "详式权益变动", "收购报告书", "重大资产重组报告书", "重组报告书", "交易报告书", "草案", "预案", "发行股份及支付现金", "协议转让")
THIN_DISCLOSURE = ("完成过户", "结果公告", "期限届满", "停牌公告", "提示性公告")
COMPLETION_HINTS = ("完成过户", "过户完成", "完成交割", "交割完成", "交易完成", "收购完成", "实施完成", "要约收购结果", "结果公告", "股权交割", "工商变更登记手续")
CONTROL_HINTS = ("控股股东发生变更", "控股股东变更", "控制权发生变更", "实际控制人发生变更", "成为公司控股股东", "变更实际控制人", "变更控股股东", "控股股东、实际控制人发生变更", "实际控制人、控股股东", "将成为上市公司控股股东", "将成为公司控股股东")
NON_CONTROL_HINTS = ("不会导致公司控股股东", "不会导致公司实际控制人", "不涉及要约收购", "实际控制权未发生变化")
SKIP_TITLE_HINTS = ("独立财务顾问", "法律意见书", "核查意见", "减值测试", "财务顾问核查")
SHARE_TRANSFER_HINTS = ("协议转让", "股份转让", "完成过户", "过户完成", "权益变动", "证券过户登记确认书")
ASSET_SWAP_HINTS = ("资产置换", "置入资产", "置出资产", "完成交割", "资产交割确认书")

#: A deal is done if one of the first patterns holds, and beyond doubt if it is one of the firm ones.
FIRM_COMPLETED = (
    "已(?:完成|交割|过户)", "(?:交易|收购|合并|股权转让|股份转让|资产转让|资产过户|交割|过户)(?:已经|已)?完成",
    "完成(?:交易|收购|并购|交割|过户|合并|股权转让|股份转让|资产转让|资产过户)", r"\bclosed\b",
)
COMPLETED = (*FIRM_COMPLETED, r"\bcompleted\b")
INCOMPLETE = (
    "进行中", "审批中", "问询", "上会", "尚未", "未完成", "待(?:完成|交割|过户|审批|审核)", "预计", "拟", "计划", "将(?:于|在)?",
    r"\bpending\b", r"\bexpected\b", "subject to", "will close", "to close", "closing conditions?", "regulatory approval",
)
TRUE_WORDS = ("true", "1", "yes", "y", "是", "已完成", "完成")
FALSE_WORDS = ("false", "0", "no", "n", "否", "未完成", "进行中", "审批中", "意向", "终止")

CATEGORIES = ("整合一级资产+资本化", "依托上市平台持续整合同类资产", "上市公司控股权并购", "重组上市（借壳，含类借壳）", "破产重整", "跨境并购", "私有化+境内上市", "SPAC", "上市公司+PE", "分拆上市")
DEFAULT_CATEGORY = "依托上市平台持续整合同类资产"
#: (words, in lower case, category): the first rule of which a word occurs decides.
CATEGORY_RULES = (
    (("spac", "de-spac", "despac"), True, "SPAC"), (("分拆", "分拆上市"), False, "分拆上市"), (("破产", "重整"), False, "破产重整"), (("私有化", "退市", "回归A股"), False, "私有化+境内上市"),
    (("mubadala", "public investment fund", "pif", "qia", "adq", "adia", "prosperity7", "g42", "etisalat"), True, "跨境并购"),
    (("跨境", "海外", "境外", "收购海外", "acquires", "acquisition", "takeover", "stake", "subscription", "placing"), False, "跨境并购"),
    (("借壳", "重组上市", "置入资产"), False, "重组上市（借壳，含类借壳）"), (("控制权", "实际控制人", "要约收购", "权益变动", "协议转让"), False, "上市公司控股权并购"), (("并购基金", "PE", "私募基金", "基金"), False, "上市公司+PE"),
)
#: What a case name says about its form rather than the deal; reports know one phrase more.
TITLE_BOILERPLATE = ("交易复盘", "案例分析", "并购案例", "交易启示", "交易观察", "并购启示", "案例研究")
NAME_BOILERPLATE = (*TITLE_BOILERPLATE, "事实复盘")
NAME_AMOUNT = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?(?:亿元|亿美元|亿港元|万元|美元|港元|元|%|％|股|股份|股权)?"
NAME_DATE = r"20[0-9]{2}[年/\-]?[0-9]{0,2}[月/\-]?[0-9]{0,2}日?"

PRIMARY_DOMAINS = (
    "cninfo.com.cn", "sse.com.cn", "szse.cn", "bse.cn", "neeq.com.cn", "hkexnews.hk", "sec.gov", "samr.gov.cn", "csrc.gov.cn", "ndrc.gov.cn", "mofcom.gov.cn", "gov.uk", "europa.eu",
    "asic.gov.au", "asx.com.au", "londonstockexchange.com", "nasdaq.com", "nyse.com", "businesswire.com", "globenewswire.com", "prnewswire.com", "accesswire.com",
    "pif.gov.sa", "mubadala.com", "qia.qa", "adq.ae", "aramcoventures.com", "g42.ai", "eand.com",
)
INVESTOR_LABELS = ("ir", "investor", "investors")
MEDIA_DOMAINS = ("reuters.com", "bloomberg.com", "wsj.com", "ft.com", "caixin.com", "yicai.com", "36kr.com", "thepaper.cn", "stcn.com", "sina.com", "163.com", "qq.com", "ifeng.com", "economictimes.com")
MEDIA_NAMES = ("新闻", "媒体", "报道", "Reuters", "Bloomberg", "财新", "第一财经", "证券时报")
BASIS_WORDS = ("对价", "估值", "股权", "收入", "净利润", "用户", "客户", "完成", "交割", "公告", "监管")

SHARE_PRICE = r"(?:要约收购价格|要约价格|收购价格|每股转让价格|每股价格|转让价格|价格为|以)(?:为人民币|为|：|:|人民币)?\s*([0-9]{1,3}(?:\.[0-9]{1,4})?\s*(?:元/股|港元/股|美元/股))"
ANY_SHARE_PRICE = r"([0-9]{1,3}(?:\.[0-9]{1,4})?\s*(?:元/股|港元/股|美元/股))"
SHARE_COUNT = r"(?:要约收购股份数量为|预定收购的股份数量|预定收购股份数量|拟协议受让|拟受让|受让其持有的|股份数量为)[^，。；:\n]{0,80}?([0-9]{1,3}(?:,[0-9]{3})+|[0-9]{6,})\s*股"
TRANSFER_PERCENTS = (
    r"(?:转让|受让)[^。；]{0,120}?占(?:公司|上市公司|总股本|公司总股本|上市公司股份总数)?[^。；]{0,30}?([0-9]+(?:\.[0-9]+)?)\s*%",
    r"(?:过户数量|过户股份数量|合计过户数量)[^。；]{0,100}?占(?:公司|上市公司|总股本|公司总股本)?[^。；]{0,30}?([0-9]+(?:\.[0-9]+)?)\s*%",
    r"(?:本次协议转让|本次股份转让|本次权益变动)[^。；]{0,160}?([0-9]+(?:\.[0-9]+)?)\s*%",
    r"([0-9]+(?:\.[0-9]+)?)\s*%[^。；]{0,40}(?:股份|股权)[^。；]{0,40}(?:转让|过户|受让)",
)
_DAY = r"(20[0-9]{2}\s*年\s*[0-9]{1,2}\s*月\s*[0-9]{1,2}\s*日)"
COMPLETION_DATES = (rf"过户日期为\s*{_DAY}", rf"{_DAY}[^。；]{{0,30}}(?:完成|办理了|取得).*?(?:过户|交割|工商变更)", rf"{_DAY}[^。；]{{0,30}}(?:过户登记|股权交割|工商变更登记)")
TRANSACTION_QUANTITY = rf"(?i){NUMBER}\s*(?:亿元|亿美元|亿港元|万元|万港元|元/股|港元/股|美元/股|元|美元|港元|股|股份|%|％|million|billion|bn|mn)"
NOISY_VALUE = ("第一节释义", "释义项指", "在本报告书中", "除非文中另有所指", "下列词语具有如下含义", "信息披露义务人", "本报告书指", "以下简称", "目录", "备查文件")
PAYMENT_HINTS = (
    "支付方式", "现金支付", "支付现金", "现金要约", "全面现金要约", "要约收购", "协议转让", "发行股份", "股份支付", "定向发行", "认购", "股权/股份受让", "全部股权/股份", "全部股份",
    "全部股权", "控股权", "控制权", "表决权", "作价出资", "非货币出资",
)
VALUE_HINTS = ("交易对价", "交易金额", "收购价格", "要约收购价格", "要约价格", "价格为", "作价", "估值", "支付", "现金", "发行股份", "可转债", "股份数量", "最终收购", "占", "元/股", "港元/股", "美元/股", "每股", "purchase price", "consideration", "valuation")
BUYER_HINTS = ("收购目的", "购买理由", "控制权", "控股股东", "取得", "入主", "谋求", "整合", "协同", "产业", "战略", "平台", "拓展", "补强", "并表", "上市公司", "buyer", "acquirer")
SELLER_HINTS = ("出售", "转让", "受让", "退出", "预受要约", "接受要约", "要约期限", "全体股东", "股东账户", "清算过户", "完成过户", "控制权变更", "现金要约", "减持", "协议转让", "seller", "shareholder", "tendered", "accepted")
SENTENCE_UNITS = ("亿元", "亿美元", "万元", "元/股", "港元/股", "美元/股", "%", "％", "股")
SENTENCE_PRICES = ("交易总价款", "股份转让对价", "转让价款", "股份转让价款", "元/股", "每股转让价格")
SENTENCE_DEALS = ("收购", "交易", "要约", "转让", "过户", "控制权")
SENTENCE_NOISE = ("释义", "本报告书", "信息披露义务人", "以下简称", "下列简称")
FACT_TOKENS = ("亿元", "亿美元", "完成", "收购", "股权", "收入", "净利润")
TIMELINE_TOKENS = ("年", "月", "日", "公告", "签署", "交割", "完成", "过户", "closed", "closing")
NUMBER_TOKENS = ("亿元", "亿美元", "万元", "%")
#: (words, angle) of an analysis, in order, and the angle that any of them brings with it.
ANGLES = (
    (("跨境", "美元", "欧元", "海外", "境外", "global", "international"), "跨境交易中的审批、交割和治理承接"), (("控股", "控制权", "股权", "表决权", "并表"), "控制权取得、股权比例和治理安排"),
    (("现金", "股份", "支付", "对价", "估值", "价格"), "价格、支付方式、估值口径和资金安排"), (("客户", "订单", "产能", "技术", "专利", "产品", "平台", "用户"), "标的业务质量、客户关系和能力承接"),
    (("收入", "营收", "净利润", "EBITDA", "毛利", "现金流", "负债"), "收入、利润、现金流和财务影响"), (("整合", "协同", "人员", "管理", "治理", "承接"), "交割后的组织、业务和管理承接"),
)
COMMON_ANGLE = "对同类并购的资料核验和执行方法论意义"

CJK = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"
QUANTITY_UNITS = (
    "平方英尺", "million", "billion", "人民币", "亿美元", "亿港元", "亿欧元", "万欧元", "平方米", "美元", "港元", "欧元", "万元", "亿元", "万股", "亿股", "GWh", "MWh", "MW", "GW", "bn", "mn",
    "元", "股", "人", "名", "户", "家", "个", "项", "台", "辆", "吨",
)
CN_NUMBERS = ("零", "一", "二", "三", "四", "五", "六", "七", "八", "九", "十")
NAME_FORMS = ("科技发展合伙企业", "管理咨询合伙企业", "合伙企业", "有限合伙", "股份有限公司", "有限责任公司", "有限公司", "集团", "控股", "公司", "Corporation", r"Inc\.", "Inc", r"Ltd\.", "Ltd", "Limited", "PLC")
TICKERS = (("NYSE:TME", "NYSE：TME"), ("NYSE： TME", "NYSE：TME"), ("NASDAQ:AMD", "NASDAQ：AMD"), ("NASDAQ： AMD", "NASDAQ：AMD"), ("NASDAQ:INTC", "NASDAQ：INTC"), ("NASDAQ： INTC", "NASDAQ：INTC"))
LOCATIONS = (
    "北京市", "上海市", "天津市", "重庆市", "深圳市", "广州市", "苏州市", "长沙市", "杭州市", "南京市", "成都市", "武汉市", "宁波市", "厦门市", "青岛市", "合肥市", "无锡市", "常州市",
    "上海", "北京", "深圳", "广州", "苏州", "长沙", "杭州", "南京", "成都", "武汉", "宁波", "厦门", "青岛", "合肥", "无锡", "常州",
)
GENERIC_NAME_PARTS = ("科技发展", "管理咨询", "数码科技", "物流技术", "测试技术", "食品包装", "国际控股", "科技集团", "科技", "技术", "发展", "投资", "控股", "集团")
AUDIENCE_REPLACEMENTS = (
    ("对上市公司董事长和CEO而言，", ""), ("对上市公司董事长和CEO而言", ""), ("对于上市公司董事长和CEO而言，", ""), ("对于上市公司董事长和CEO而言", ""), ("对董事长和CEO而言，", ""), ("对董事长和CEO而言", ""),
    ("对CEO而言，", ""), ("对CEO而言", ""), ("上市公司CEO", "管理层"), ("上市公司ceo", "管理层"), ("上市公司董事长", "管理层"), ("董事长和CEO", "管理层"), ("董事长/CEO", "管理层"), ("CEO和董事长", "管理层"), ("CEO/董事长", "管理层"), ("CEO", "管理层"),
)
TONE_REPLACEMENTS = (
    ("本文将", "本案例围绕公开资料"), ("本文认为", "公开资料显示"), ("本文分析", "本案例复盘"), ("本文", "本案例"), ("本报告", "本案例"), ("假设", "情形"), ("推测", "判断"), ("猜测", "判断"), ("有望", "相关安排指向"),
    ("或许", "公开资料未进一步披露"), ("大概", "约"), ("预计将", "计划"), ("不排除", "存在"), ("可能是", "公开资料显示为"), ("可能会", "相关安排指向"), ("如果", "在公开资料所示条件下"), ("若未", "公开资料显示未"), ("若能", "相关安排落实后"),
    ("避坑", "关注事项"), ("踩雷", "风险事项"), ("暴雷", "风险暴露"), ("豪赌", "重大投入"), ("神话", "代表性案例"), ("翻车", "执行偏差"), ("失败教训", "经验复盘"),
)

# Rules of report articles.
BANNED_INTRO = ("本文", "本报告", "本文将", "本文认为", "本文分析", "以下将")
BANNED_AUDIENCE = ("上市公司CEO", "上市公司ceo", "上市公司的CEO", "上市公司的ceo", "上市公司董事长", "董事长和CEO", "董事长/CEO", "CEO和董事长", "CEO/董事长", "对CEO而言", "对董事长而言", "对上市公司管理者而言", "读者是", "面向上市公司")
GENERIC_HEADINGS = ("交易过程", "交易逻辑", "可复用经验", "结论", "经验启示", "案例启示")
GENERIC_CONCLUSIONS = ("并购不是终点", "整合才是开始", "协同不是口号", "时间会给出答案", "值得长期关注", "只有真正整合才能释放价值", "对企业具有重要启示", "为同类交易提供了借鉴")
GENERIC_ENDINGS = (*GENERIC_CONCLUSIONS, "具有参考意义", "未来仍需观察")
THINKING_HEADINGS = ("交易动机", "交易背景", "并购战略考量", "标的筛选", "交易结构设计", "并购后整合", "价值释放", "买方动机", "卖方动机", "投后整合")
BANNED_TONE = ("窗口期如何打开", "用条款把不确定性前置", "交割后的第一件事是接住能力", "为何此时走到一起", "资产质量先于规模想象", "产业位置决定出手方式", "避坑", "踩雷", "暴雷", "豪赌", "神话", "翻车", "失败教训")
HYPOTHESES = ("假设", "推测", "猜测", "可能是", "或许", "大概", "预计将", "有望", "如果", "若未", "若能", "可能会", "不排除", "could", "may ", "might", "possibly")
TIME_WORDS = ("2025", "2026", "2024", "2023", "交割", "完成", "签约", "公告", "过户", "协议", "closing", "closed")
CONSIDERATION_WORDS = ("亿元", "亿美元", "万欧元", "亿欧元", "万元", "元/股", "港元/股", "美元/股", "对价", "估值", "交易金额", "作价", "价格", "现金", "股份")
FINANCIAL_WORDS = ("营收", "收入", "营业收入", "净利润", "毛利", "EBITDA", "现金流", "负债", "市值", "产能", "订单", "用户", "员工", "股权", "资源量", "储量")
BUYER_WORDS = ("买方", "收购方", "并购方", "购买", "收购目的", "战略目的", "补强", "整合", "协同", "控股", "并表")
SELLER_WORDS = ("卖方", "出售方", "标的方", "转让方", "被整合方", "退出", "出售股权", "出让", "接受", "承接", "私有化", "预受要约", "接受要约", "现金要约", "协议转让", "减持", "股东账户")
INTRO_WORDS = ("基本介绍", "主营", "主营业务", "业务", "收入", "净利润", "成立", "上市", "资产", "产品", "客户")
CONCRETE_WORDS = (
    "对价", "估值", "支付", "股权", "控制权", "并表", "交割", "过户", "公告", "协议", "收入", "营收", "净利润", "现金流", "负债", "产能", "订单", "客户", "用户", "员工", "技术", "专利", "资源", "门店", "平台", "监管", "审批", "锁定期", "业绩承诺",
)
TEMPLATE_HEADINGS = ("关键事实与交易进程", "关键事实、交易进程与披露边界", "交易双方的业务基础与披露信息", "价格、支付方式与交割条件安排", "交割后的治理、业务与人员承接", "业务承接、治理安排与后续观察", "从公开事实回到执行关注点")
TEMPLATE_PHRASES = ("公开资料能够直接复核的事实包括", "这些信息决定了复盘边界", "从收购方角度看", "从出售方或被整合方角度看", "数据层面的复核重点包括", "相关安排的后续观察重点", "只能回到公开资料")
WEAK_TITLES = ("交易复盘", "案例分析", "并购案例", "交易启示", "交易观察", "并购启示", "案例研究", "一文看懂", "深度解析", "全面复盘", "重大交易")
MEDIA_TONE = ("悬疑", "尖厉问号", "尖锐问号", "杠杆悬河", "治理真空", "协同的虚实", "陡坡", "搏杀", "资本游戏", "暗礁", "蒸发", "拉响", "抛出", "剑指", "闪电成立", "新壳", "杠杆入主", "撬动", "迷局", "戏码", "狂飙", "风暴")
INDUSTRY_TERMS = ("行业", "产业", "产业链", "竞争格局", "市场格局", "供需", "周期", "渗透率", "客户结构", "技术路线", "商业模式", "产品结构", "区域市场", "监管环境", "上市平台", "资源禀赋")
STRUCTURE_TERMS = ("对价", "估值", "作价", "支付方式", "现金支付", "股份支付", "股权比例", "控制权", "表决权", "交割条件", "先决条件", "业绩承诺", "锁定期", "融资安排", "并表", "治理安排", "要约")
METHOD_TERMS = ("方法论", "核验", "尽调", "估值锚", "交易执行", "交割承接", "治理边界", "整合节奏", "信息披露", "承接能力", "协同边界", "执行条件", "风险隔离", "条款设计", "复盘")
FINANCE_TERMS = ("收入", "营收", "净利润", "毛利", "EBITDA", "现金流", "负债", "资产", "市值", "估值倍数", "利润率", "资产负债率", "订单", "产能", "客户", "用户")
BACKGROUND_TERMS = ("交易前", "此前", "原控股股东", "股权结构", "控制权状态", "无实际控制人", "经营压力", "业务状态", "产业位置", "主业", "上市平台", "分散", "承压", "转型")
INITIATION_TERMS = ("发起", "启动", "公告", "披露", "签署", "董事会", "股东会", "决议", "要约", "协议", "预案", "报告书", "监管", "过户", "交割", "触发")
OBJECTIVE_TERMS = ("目的", "目标", "旨在", "为了", "意在", "希望", "取得控制权", "提升持股", "内部整合", "产业协同", "资产注入", "退出", "变现", "优化资本结构", "补强", "并表", "治理")
CAUSAL_WORDS = ("原因在于", "这意味着", "其约束在于", "真正关键", "底层逻辑", "对应的是", "不是", "而是", "因此", "从而")
METHOD_WORDS = ("方法论", "同类并购", "执行条件", "核验", "治理边界", "交割承接", "整合节奏", "条款安排")
INDUSTRY_WORDS = ("产业链", "行业", "竞争格局", "客户结构", "技术路线", "商业模式", "资源禀赋", "产业位置")
TITLE_TOPICS = (*STRUCTURE_TERMS, *INDUSTRY_TERMS, *FINANCE_TERMS, "承接", "协同", "治理", "平台", "私有化", "控制权")

# What a deal turns on, in the order of the check, and short forms of cities in titles: fixed values.
FOCUS = (
    (("要约",), "要约与控制权安排"), (("控制权", "控股权", "表决权"), "控制权与治理安排"), (("现金",), "现金支付与业务承接"), (("协议转让", "受让"), "协议转让与交割条件"),
    (("股权", "股份", "%", "％"), "股权比例与治理安排"),
)
FOCUS_OTHERWISE, FOCUS_SHORT = "披露边界下的交易结构", "控制权安排"
SHORT_CITIES = (("上海市", "上海"), ("深圳市", "深圳"), ("杭州市", "杭州"))
