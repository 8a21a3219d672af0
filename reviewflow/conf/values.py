"""Values that the results depend on: term lists, header aliases, platform layouts. Plain data, no logic."""

# Texts that stand for an empty comment.
PLACEHOLDERS = (
    "该用户未填写评价内容", "此用户未填写评价内容",
)

# Deletion terms compared with letter case, in order.
TERMS_EXACT = (
    "链接", "凑字数", "水经验", "赚积分", "为了金币", "赚硬币", "赚京豆", "淘气值", "为了评论而评论", "混个脸熟", "完成任务", "代下", "代买", "内部券", "加微", "加v", "私聊我", "主页看", "点击链接",
    "http://", "https://", "打卡", "冒泡", "占座", "无内容", "暂无评价", "蹲", "蹲一个", "求链接", "求分享", "多少钱", "怎么卖", "啥牌子", "什么牌子", "求品牌", "求私", "加群", "裙内",
    "互赞", "互粉", "互关", "回关", "秒回", "交朋友", "优惠", "好物", "红包", "特价", "国补", "リンク", "プロフィール見て", "プロフ見て", "DMして", "フォロー返し", "相互フォロー", "テスト",
    "内容なし", "評価なし", "コメント稼ぎ", "割引", "良いもの", "お年玉", "特価", "国の補助金", "링크", "맞팔", "테스트", "내용 없음", "할인", "좋은 물건", "홍바오", "특가", "국가 보조금",
)

# Deletion terms compared without letter case, in order.
TERMS_ANY_CASE = (
    "加v", "link in bio", "click link", "click the link", "check my profile", "see my profile", "visit my profile", "dm me", "message me",
    "follow me", "follow back", "follow for follow", "sub4sub", "sub for sub", "subscribe to my channel", "earn coins", "free coins",
    "for coins", "comment for points", "promo code", "coupon code", "discount code", "discount", "good stuff", "red envelope",
    "special price", "national subsidy", "whatsapp", "telegram", "n/a", "no content", "no comment", "nothing to say", "what brand",
    "brand?", "share link", "need link", "passing by", "check in", "enlace", "link en bio", "haz clic en el enlace", "mira mi perfil",
    "revisa mi perfil", "mándame dm", "mandame dm", "escríbeme", "escribeme", "sígueme", "sigueme", "te sigo", "cupón", "cupon",
    "código promocional", "codigo promocional", "descuento", "cosas buenas", "sobre rojo", "precio especial", "subsidio nacional",
    "primero", "prueba", "sin contenido", "sin comentario", "nada que decir", "cuánto cuesta", "cuanto cuesta", "precio", "qué marca",
    "que marca", "marca?", "pásame el link", "pasame el link", "necesito el link", "ลิงก์", "ขอลิงก์", "ส่งลิงก์", "ดูโปรไฟล์", "ทัก dm",
    "dm มา", "ติดตามกลับ", "ฟอลกลับ", "ทดสอบ", "ไม่มีเนื้อหา", "ไม่มีความคิดเห็น", "ปั๊มคอมเมนต์", "เก็บแต้ม", "ส่วนลด", "ของดี",
    "อั่งเปา", "ราคาพิเศษ", "เงินอุดหนุนจากรัฐ", "ราคาเท่าไหร่", "กี่บาท", "ยี่ห้ออะไร", "แบรนด์อะไร", "ผ่านมา", "เช็คชื่อ", "ทำภารกิจ",
    "लिंक", "लिंक दो", "लिंक भेजो", "प्रोफाइल देखें", "डीएम करें", "dm करें", "फॉलो बैक", "मुझे फॉलो करें", "टेस्ट", "कोई सामग्री नहीं",
    "कोई टिप्पणी नहीं", "पॉइंट कमाने", "सिक्के कमाने", "छूट", "अच्छी चीज़", "लाल लिफाफा", "विशेष कीमत", "राष्ट्रीय सब्सिडी", "कितने का है",
    "कीमत", "कौन सा ब्रांड", "ब्रांड क्या है", "बस गुजर रहा", "चेक इन", "काम पूरा",
)

# Script groups of terms that their characters would not show.
TERM_SCRIPTS = {"割引": "japanese", "特価": "japanese"}

# Lengths and ratios of the deletion rules.
MIN_LENGTH = 8
SHORT_WORDS = 2
SHORT_UNSPACED = 4
RANDOM_DIGITS = 9
RANDOM_LETTERS = 10
RANDOM_MIXED = 10
VOWEL_RATIO = 0.2
CONSONANT_RUN = 5
SUBCOMMENT_LENGTH = 6

# The eleven output fields in order, each with its source headers.
ALIASES = {
    "评论日期": (
        "评论日期", "评论时间", "评论日期与产品", "timestamp", "createTime", "create_time", "createdAt", "created_at", "createDate", "create_date",
        "publishedAt", "published_at", "publishedTime", "published_time", "published", "date", "Date", "time", "Time", "commentTime",
        "comment_time", "Comment Published", "Published At",
    ),
    "评论内容": (
        "评论内容", "评论", "content", "text", "Text", "comment", "Comment", "commentText", "comment_text", "Comment Text", "message", "body",
    ),
    "产品名": (
        "产品名", "购买产品", "商品名称", "商品", "评论日期与产品",
    ),
    "电商平台评分": (
        "电商平台评分",
    ),
    "用户属性": (
        "用户属性",
    ),
    "哈希ID": (),
    "点赞数": (
        "点赞数", "点赞量", "Digg Count", "like_count", "likeCount", "Like Count", "likes", "Likes", "diggCount", "digg_count",
    ),
    "子评论数/追评数": (
        "子评论数/追评数", "子评论数", "子评论数（追评数）", "追评数", "评论数", "回复数", "replyCount", "reply_count", "Reply Count", "replyCommentTotal",
        "reply_comment_total", "replies", "Replies",
    ),
    "一级评论": (
        "一级评论", "一级评论内容", "追评", "replyText", "reply_text", "Reply Text",
    ),
    "二级评论": (
        "二级评论", "二级评论内容", "引用的评论内容",
    ),
    "三级评论": (
        "三级评论", "三级评论内容",
    ),
}
REQUIRED = ("评论日期", "评论内容")
# Headers that together give a field.
COMPOSITE = {"用户属性": ("性别", "年龄")}

# Headers reported as dropped for privacy.
DROP_HEADERS = (
    "IP地址", "IP属地", "用户名称", "用户昵称", "昵称", "乐天市场昵称", "rpid", "parent_rpid", "username", "ip_location", "id", "comment_id", "commentId",
    "cid", "uid", "user_id", "userId", "uniqueId", "author", "authorName", "author_name", "authorDisplayName", "authorChannelId",
    "authorChannelUrl", "channelId", "channel_id", "channelUrl", "profileUrl", "profile_url", "avatar", "videoId", "video_id", "videoUrl",
    "url", "permalink",
)

# Platform layouts. Each layout: name, source headers, and (output field, operation, source headers).
LAYOUTS = {
    "amazon-japan": (
        (
            "default",
            (
                "标题", "标题链接", "图片", "aprofile_链接", "名称", "aiconalt", "查看", "状态", "查看1", "asizebase", "crhelpfultext", "asizebase_链接",
                "asizebase2",
            ),
            (
                ("评论日期", "amazon_review_date", ("查看",)),
                ("评论内容", "join_trimmed", ("标题", "查看1")),
                ("电商平台评分", "amazon_star_rating", ("aiconalt",)),
                ("点赞数", "amazon_helpful_count", ("asizebase",)),
                ("名称", "copy", ("名称",)),
            ),
        ),
    ),
    "amazon-us": (
        (
            "default",
            (
                "标题", "标题链接", "图片", "aprofile_链接", "名称", "aiconalt", "查看", "状态", "查看1", "asizebase",
            ),
            (
                ("评论日期", "empty", ()),
                ("评论内容", "join_trimmed", ("标题", "查看1")),
                ("电商平台评分", "amazon_star_rating", ("aiconalt",)),
                ("点赞数", "amazon_helpful_count", ("asizebase",)),
                ("名称", "copy", ("名称",)),
            ),
        ),
    ),
    "rakuten": (
        (
            "reviewer-title-body-review-date",
            (
                "レビュータイトル", "評価", "レビュー本文", "レビュー投稿者", "レビュー投稿日", "注文日", "レビュアー属性", "参考になった数",
            ),
            (
                ("评论日期", "rakuten_review_date", ("レビュー投稿日",)),
                ("评论内容", "join_trimmed", ("レビュータイトル", "レビュー本文")),
                ("电商平台评分", "copy", ("評価",)),
                ("用户属性", "rakuten_user_attribute", ("レビュアー属性",)),
                ("点赞数", "rakuten_helpful_count", ("参考になった数",)),
                ("乐天市场昵称", "rakuten_display_name", ("レビュー投稿者",)),
            ),
        ),
        (
            "reviewer-date-body-title",
            (
                "レビュー投稿者", "評価", "投稿日", "レビュー本文", "レビュータイトル", "レビュアー属性", "参考になった数",
            ),
            (
                ("评论日期", "rakuten_review_date", ("投稿日",)),
                ("评论内容", "join_trimmed", ("レビュータイトル", "レビュー本文")),
                ("电商平台评分", "copy", ("評価",)),
                ("用户属性", "rakuten_user_attribute", ("レビュアー属性",)),
                ("点赞数", "rakuten_helpful_count", ("参考になった数",)),
                ("乐天市场昵称", "rakuten_display_name", ("レビュー投稿者",)),
            ),
        ),
        (
            "title-review-date-body-reviewer",
            (
                "レビュータイトル", "評価", "レビュー投稿日", "レビュー本文", "レビュー投稿者", "注文日", "レビュアー属性", "参考になった数",
            ),
            (
                ("评论日期", "rakuten_review_date", ("レビュー投稿日",)),
                ("评论内容", "join_trimmed", ("レビュータイトル", "レビュー本文")),
                ("电商平台评分", "copy", ("評価",)),
                ("用户属性", "rakuten_user_attribute", ("レビュアー属性",)),
                ("点赞数", "rakuten_helpful_count", ("参考になった数",)),
                ("乐天市场昵称", "rakuten_display_name", ("レビュー投稿者",)),
            ),
        ),
        (
            "poster-title-body-review-date",
            (
                "レビュータイトル", "評価", "レビュー投稿日", "投稿者名", "レビュー本文", "レビュアー属性", "参考になった数",
            ),
            (
                ("评论日期", "rakuten_review_date", ("レビュー投稿日",)),
                ("评论内容", "join_trimmed", ("レビュータイトル", "レビュー本文")),
                ("电商平台评分", "copy", ("評価",)),
                ("用户属性", "rakuten_user_attribute", ("レビュアー属性",)),
                ("点赞数", "rakuten_helpful_count", ("参考になった数",)),
                ("乐天市场昵称", "rakuten_display_name", ("投稿者名",)),
            ),
        ),
        (
            "reviewer-name-title-content",
            (
                "レビュアー名", "評価", "投稿日", "カラー", "レビュータイトル", "レビュー内容", "レビュアー属性", "参考になった数",
            ),
            (
                ("评论日期", "rakuten_review_date", ("投稿日",)),
                ("评论内容", "join_trimmed", ("レビュータイトル", "レビュー内容")),
                ("电商平台评分", "copy", ("評価",)),
                ("用户属性", "rakuten_user_attribute", ("レビュアー属性",)),
                ("点赞数", "rakuten_helpful_count", ("参考になった数",)),
                ("乐天市场昵称", "rakuten_display_name", ("レビュアー名",)),
            ),
        ),
    ),
    "twitter": (
        (
            "default",
            (
                "id", "created_at", "full_text", "media", "screen_name", "name", "profile_image_url", "user_id", "in_reply_to",
                "retweeted_status", "quoted_status", "media_tags", "favorite_count", "retweet_count", "bookmark_count", "quote_count",
                "reply_count", "views_count", "favorited", "retweeted", "bookmarked", "url", "metadata",
            ),
            (
                ("评论日期", "copy", ("created_at",)),
                ("评论内容", "copy", ("full_text",)),
                ("点赞数", "copy", ("favorite_count",)),
                ("子评论数/追评数", "copy", ("reply_count",)),
                ("Twitter用户ID", "copy", ("user_id",)),
                ("Twitter昵称", "copy", ("screen_name",)),
            ),
        ),
    ),
    "twitter-comments": (
        (
            "default",
            (
                "id", "created_at", "full_text", "media", "screen_name", "name", "profile_image_url", "user_id", "in_reply_to",
                "retweeted_status", "quoted_status", "media_tags", "favorite_count", "retweet_count", "bookmark_count", "quote_count",
                "reply_count", "views_count", "favorited", "retweeted", "bookmarked", "url", "metadata",
            ),
            (
                ("评论日期", "copy", ("created_at",)),
                ("评论内容", "copy", ("full_text",)),
                ("点赞数", "copy", ("favorite_count",)),
                ("子评论数/追评数", "copy", ("reply_count",)),
                ("Twitter用户ID", "copy", ("user_id",)),
                ("Twitter昵称", "copy", ("screen_name",)),
            ),
        ),
    ),
    "reddit": (
        (
            "default",
            (
                "记录类型", "标题", "作者", "时间", "内容", "点赞数", "评论/回复数", "层级", "是否回复", "评论ID", "父ID",
            ),
            (
                ("评论日期", "copy", ("时间",)),
                ("评论内容", "join_trimmed", ("标题", "内容")),
                ("点赞数", "copy", ("点赞数",)),
                ("子评论数/追评数", "copy", ("评论/回复数",)),
                ("Reddit作者", "copy", ("作者",)),
            ),
        ),
    ),
}
# Other names of the platforms that have layouts.
LAYOUT_NAMES = {
    "amazon-japan": ["亚马逊日本", "Amazon Japan", "amazon.co.jp"],
    "amazon-us": ["亚马逊美国", "Amazon USA", "Amazon US", "amazon.com"],
    "rakuten": ["乐天市场", "Rakuten", "rakuten"],
    "twitter": ["Twitter", "twitter", "X", "x"],
    "twitter-comments": [],
    "reddit": ["Reddit", "reddit"],
}
JOIN_SEPARATOR = "\n\n"

# The tag of the pseudonym algorithm, and the identity headers of each platform.
ALGORITHM = "bazhuayu-hash-id-v1"
IDENTITIES = {
    "youtube": {"names": ["YouTube", "YouTube Shorts", "youtube", "yt-comments"], "accounts": ["author_channel_id", "authorChannelId", "Author Channel ID"], "display": ["author", "author_name"]},
    "xiaohongshu": {"names": ["小红书"], "accounts": ["用户ID"], "display": ["用户名称"]},
    "bilibili": {"names": ["B站", "哔哩哔哩", "bilibili"], "accounts": [], "display": ["username"]},
    "tiktok": {"names": ["TikTok", "TTCommentExporter"], "accounts": [], "display": ["用户名", "昵称"]},
    "taobao": {"names": ["淘宝"], "accounts": [], "display": ["用户名称", "用户名"]},
    "jd": {"names": ["京东"], "accounts": [], "display": ["用户名"]},
    "amazon-japan": {"names": ["亚马逊日本", "Amazon Japan", "amazon.co.jp"], "accounts": [], "display": ["名称"]},
    "amazon-us": {"names": ["亚马逊美国", "Amazon USA", "Amazon US", "amazon.com"], "accounts": [], "display": ["名称"]},
    "rakuten": {"names": ["乐天市场", "Rakuten", "rakuten"], "accounts": [], "display": ["乐天市场昵称"]},
    "twitter": {"names": ["Twitter", "twitter", "X", "x", "twitter-comments"], "accounts": ["Twitter用户ID"], "display": ["Twitter昵称"]},
    "reddit": {"names": ["Reddit", "reddit"], "accounts": [], "display": ["Reddit作者"]},
}
