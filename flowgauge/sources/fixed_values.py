"""Names, labels and ids that results must show exactly as given here."""

# Line id -> line name.
LINE_NAMES = {
    "A": "杭州地铁4号线",
    "B": "杭州地铁1号线",
    "C": "杭州地铁2号线",
}

# Station names in id order, ids 0 to 80.
STATION_NAMES = [
    "湘湖", "滨康路", "西兴", "滨和路", "江陵路", "近江", "婺江路", "城站", "定安路", "龙翔桥",
    "凤起路", "武林广场", "西湖文化广场", "打铁关", "闸弄口", "火车东站", "彭埠", "七堡", "九和路", "九堡",
    "客运中心", "下沙西", "金沙湖", "高沙路", "文泽路", "文海南路", "云水", "下沙江滨", "乔司南", "乔司",
    "翁梅", "余杭高铁", "南苑", "临平", "朝阳", "曹家桥", "潘水", "人民路", "杭发厂", "人民广场",
    "建设一路", "建设三路", "振宁路", "飞虹路", "盈丰路", "钱江世纪城", "钱江路", "庆春广场", "庆菱路", "建国北路",
    "中河北路", "凤起路", "武林门", "沈塘桥", "下宁桥", "学院路", "古翠路", "丰潭路", "文新", "三坝",
    "虾龙圩", "三墩", "墩祥街", "金家渡", "白洋", "杜甫村", "良渚", "浦沿站", "杨家墩站", "中医药大学站",
    "联庄站", "水澄桥站", "复兴路站", "南星桥站", "甬江路站", "城星路站", "市民中心站", "江锦路站", "景芳站", "新塘站",
    "新风站",
]

# Chart labels of the stations that are forecast by default; the keys are the default target stations.
TARGET_STATION_LABELS = {
    10: "凤起路站",
    12: "西湖文化广场站",
    15: "火车东站",
    20: "客运中心站",
    24: "文泽路站",
}
TARGET_STATIONS = list(TARGET_STATION_LABELS)

# Label of a station without a name is this prefix and its id.
STATION_PREFIX = "站点"

# Weekday labels, Monday first.
WEEKDAY_LABELS = ["周一", "周二", "周三", "周四", "周五", "周六", "周日"]

# Report wording.
ACTUAL_LABEL = "实际值"
FORECAST_LABEL = "预测值"
REPORT_COLUMNS = ["日期", "星期", "进站人数", "出站人数", "数据类型"]
MANY_DAYS_LABEL = "多天数据"

# Raw columns that carry no flow information.
UNUSED_COLUMNS = ["payType", "deviceID"]
