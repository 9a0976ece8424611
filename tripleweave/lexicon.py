"""Word lists, rule constants, prompt texts and formats.

Everything here is a default. Each operator that uses a list takes it as a
parameter, so another domain or language only passes other values.
"""

from __future__ import annotations

# --- fixed values: entity categories, in display order ----------------------
CATEGORIES = ["Location", "Land use function", "Direction", "Concept", "Planned activity"]

# --- fixed values: tagging lexicon, (category, keywords, canonical entity) --
TAG_LEXICON = [
    ("Concept", ["规划", "建筑", "设计"], "规划设计"),
    ("Planned activity", ["发展", "建设"], "发展建设"),
    ("Location", ["地点", "区", "城市"], "城市地区"),
    ("Land use function", ["产业", "功能"], "产业功能区"),
    ("Direction", ["北", "南", "东", "西"], "方位指向"),
]

# --- fixed values: constants of the triple rules ----------------------------
ACTIVITY_GOAL = "发展目标"
FUNCTION_HEAD = "城市规划"
FUNCTION_RELATION = "实现"
ACTIVITY_HEAD = "政府"
ACTIVITY_RELATION = "推进"
PLACEHOLDER_TRIPLE = ("演示", "三元组", "示例")

# --- fixed values: hub concept ----------------------------------------------
HUB = "本土设计"
HUB_RELATION = "相关于"

# --- fixed values: triple cleaning ------------------------------------------
PLACEHOLDER_WORDS = ["演示", "示例", "三元组", "demo"]
RELATION_KEYWORDS = [
    "推进", "促进", "推动", "实现", "完成", "发展", "建设", "规划",
    "计划", "采用", "覆盖", "建立", "设置", "改善", "增加", "实施",
]
SINGLE_CHAR_ENTITIES = ["北", "南", "东", "西", "中", "上", "下"]
# first matching group wins
RELATION_GROUPS = [
    (["推进", "促进", "推动"], "推进"),
    (["实现", "完成"], "实现"),
    (["发展", "建设"], "发展"),
    (["规划", "计划"], "规划活动"),
]
REASONS = ["bad_format", "placeholder", "head_eq_tail", "invalid_entity", "rel_no_keyword", "dup", "llm_parse_error"]

# --- fixed values: graph -----------------------------------------------------
NODE_LABEL = "Entity"
EMPTY_RELATION_TYPE = "REL"
RELATION_TYPE_PREFIX = "R_"

# --- fixed values: prompt texts ({...} marks what is filled in per row) ------
NER_SYSTEM = (
    "你是一个城市规划专家。请从给定文本中提取以下5类实体："
    "Location (地点)、Land use function (用地功能)、Direction (方位)、"
    "Concept (规划概念)、Planned activity (规划行动/动词)。"
)
NER_EXAMPLE_INPUT = (
    "Priority is given to securing development space for advanced manufacturing, strategic emerging industry, "
    "and urban industry, while promoting the construction of value innovation parks."
)
NER_EXAMPLE_OUTPUT = {
    "Location": [],
    "Land use function": ["advanced manufacturing", "strategic emerging industry", "urban industry",
                          "value innovation park"],
    "Direction": [],
    "Concept": [],
    "Planned activity": ["give priority to", "promote"],
}
NER_EXAMPLE = '示例输入: "{input}"\n示例输出(仅JSON): {output}'
NER_USER = "请仅输出标准 JSON。要提取的文本：\n{text}"

NER_HUB_SYSTEM = """
你是一个城市规划与建筑领域的知识图谱专家。
你的任务是从文本中提取与核心概念【{hub}】紧密相关的实体。

请提取以下5类实体：
1. Location (地点): 与{hub}发生关联的具体场所。
2. Land use function (用地功能): 涉及{hub}的功能区。
3. Direction (方位): 空间方位。
4. Concept (规划概念): 与{hub}相关的理论、理念或专有名词。
5. Planned activity (规划行动): 针对{hub}采取的具体动作。

注意：如果实体与【{hub}】完全无关，请不要提取，以减少图谱中的噪音。
"""
NER_HUB_EXAMPLE_INPUT = (
    "在南沙区的规划中，我们将优先考虑融合岭南文化的本土设计元素，"
    "推广具有地域特色的绿色建筑技术。"
)
NER_HUB_EXAMPLE_OUTPUT = {
    "Location": ["南沙区"],
    "Land use function": [],
    "Direction": [],
    "Concept": ["岭南文化", "本土设计元素", "地域特色", "绿色建筑技术"],
    "Planned activity": ["优先考虑", "融合", "推广"],
}
NER_HUB_EXAMPLE = '示例输入: "{input}"\n示例输出(JSON): {output}'
NER_HUB_USER = "请仅输出标准 JSON。\n当前任务的核心关注点是：【{hub}】\n要提取的文本：\n{text}"

RE_SYSTEM = (
    "你是一个城市规划专家。给定原文与已抽取实体，请判断哪些实体之间存在“规划活动”(Planned activity)关系，"
    "并按 [主语, 谓语, 宾语] 格式返回三元组列表。只输出 JSON 数组。"
)
RE_USER = (
    "原文：\n{text}\n\n已提取实体：{entities}\n\n任务：请找出所有由“规划活动”(Planned activity)连接的主-谓-宾三元组。"
    '仅输出 JSON 数组，例如 [["政府", "加强", "基础设施建设"]]。'
)
RE_HUB_SYSTEM = """
你是一个城市规划专家，专注于构建关于【{hub}】的知识图谱。
你的目标是解决“数据孤岛”问题，确保提取出的实体尽可能连接到核心网络中。

任务规则：
1. 分析原文和已提取的实体。
2. 提取原文中明确的实体间关系（如：[政府, 推广, 绿色建筑]）。
3. 【关键步骤】：必须尝试寻找实体与核心概念【{hub}】之间的关系。
   - 如果原文提到某地正在实施规划，且上下文隐含这是为了{hub}，请生成 <地点, 实施, {hub}>。
   - 如果某概念属于{hub}的一部分，请生成 <概念, 属于, {hub}>。
4. 关系谓词不限于“规划活动”，可以使用：包含、属于、位于、促进、阻碍、相关于、旨在实现。
5. 仅输出 JSON 数组格式。
"""
RE_HUB_USER = (
    "核心概念：【{hub}】\n原文：\n{text}\n\n已识别实体：[{entities}]\n\n"
    "请提取三元组，格式为 [[Head, Relation, Tail]]。\n"
    "特别注意：如果实体与【{hub}】有隐含关联，请务必显式生成一条包含“{hub}”作为头实体或尾实体的三元组，以消除孤岛。"
)

CORE_PROMPT = (
    "系统：你是一个NLP专家，专注于城市规划领域的关系抽取（RE）任务。\n"
    "用户：你的任务是根据提供的信息，在每个输入句子中提取关系三元组。\n\n"
    "段落的背景内容：\n{text}\n\n"
    "句法分析结果：\n依存关系：{dep}\n成分分析：{con}\n\n"
    "任务目标：\n围绕核心概念【{concepts}】进行抽取。"
    "请确保提取的三元组中，头实体或尾实体至少有一个与上述核心概念语义高度相关。\n\n"
    "实体约束（a1）：\n"
    "- 头实体/主语（h/sbj）和尾实体/宾语（t/obj）必须属于以下类别：[地点, 土地使用功能, 方向, 概念]。\n"
    "- 关系谓词（r/pred）必须属于：[计划活动, 土地添加] 或同义动作。\n\n"
    "输出约束（b1）：\n- 仅输出关系三元组。避免任何附加的解释或描述。\n- 格式严格如下：{format}\n"
)
CORE_FORMAT = "< h/sbj, r/pred, t/obj >"
CORE_CONCEPTS = ["城市更新"]
# --- end of fixed values -----------------------------------------------------

# The parsers read JSON, so a flow that feeds answers to them asks for JSON
# instead of CORE_FORMAT.
CORE_FORMAT_JSON = '[["h/sbj", "r/pred", "t/obj"]]'
