"""Rule tables of the listings domain.

Everything in this module is a FIXED VALUE: the word lists, patterns, limits and
message texts must equal the established ones for results to agree.  They are
plain data, may be swapped by the caller, and hold no logic.
"""

# Category slugs.
CATEGORIES = [
    "car-draws",
    "cash-prizes",
    "house-draws",
    "tech-giveaways",
    "luxury",
    "collectibles",
    "sports-outdoors",
    "home-garden",
]

# Category sources that a rule may never overwrite.
JUDGED_SOURCES = ["claude", "manual"]
CATEGORY_SOURCES = ["rule", "claude", "manual"]

# Columns an editor may patch.
PATCHABLE = [
    "prize_description",
    "status",
    "category_id",
    "category_source",
    "title",
    "grand_prize",
    "image_url",
    "draw_date",
    "ticket_price",
    "total_entries",
    "total_prize_value",
    "featured",
]

# Gate limits.
WINDOW_DAYS = 35
RELAXED_WINDOW_DAYS = 90
MIN_ENTRIES = 500
MIN_ENTRIES_COLLECTIBLE = 50
REQUIRED_FIELDS = ["title", "ticket_price", "total_entries", "draw_date", "image_url", "entry_url"]

# Prize text -> category, tested in this order; the first match wins.
CATEGORY_RULES = {
    "collectibles": r"\b(lego|warhammer|age of sigmar|sigmar|slaanesh|nighthaunt|stormcast|astra militarum|space marines?|necrons?|tyranids?|aeldari|horus heresy|kill team|games workshop|citadel|gundam|airfix|model kit|pok[eéÉ]mon|pikachu|charizard|tcg|trading cards?|lorcana|magic the gathering|\bmtg\b|yu-?gi-?oh|funko|graded|psa ?10|gem ?mint|holo|slab|miniature|collectible|memorabilia|signed (?:shirt|jersey|boots?|glove))\b",
    "house-draws": r"\b(house draws?|(?:win|won) (?:a|this|your(?: own)?|our) (?:\d+[\s-]?bed(?:room)?s?\s+)?(?:house|home|flat|apartment|bungalow|cottage)|dream home|mortgage[- ]?free|property (?:draw|raffle|competition)|(?:house|home|flat|apartment|villa|bungalow|cottage) (?:worth|valued)|holiday home)\b",
    "car-draws": r"\b(cars?|bmw|audi|mercedes|merc|amg|porsche|ford|focus|fiesta|vw|volkswagen|(?:vw|volkswagen)\s+golf|golf\s+(?:gti|gtd|gte|r\b)|polo (?:gti|match|bluemotion|\d)|vw polo|volkswagen polo|scirocco|gti|gtr|m2|m3|m4|m5|rs\d|a45|c63|motorbike|motorcycle|moped|van\b|campervan|vehicle|supercar|hypercar|tesla|lamborghini|lambo|(?:ac|shelby) cobra|ferrari|range\s?rover|land\s?rover|defender|peugeot|vauxhall|corsa|astra|insignia|nissan|skyline|toyota|supra|yaris|honda|civic|jaguar|mini cooper|seat (?:leon|ibiza|ateca|arona|alhambra|tarraco)|cupra|skoda|renault|fiat|kia|hyundai|mazda|subaru|impreza|bentley|aston\s?martin|mclaren|maserati|jeep|suzuki|yamaha|kawasaki|ducati|volvo|bugatti|rolls\s?royce)\b",
    "sports-outdoors": r"\b(golf|cobra (?:golf|rad|king|darkspeed|aerojet|ltdx|f-?max)\w*|taylormade|callaway|titleist|mizuno|srixon|powakaddy|motocaddy|odyssey|scotty cameron|shot ?scope|pxg|ogio|j ?lindeberg|footjoy|garmin approach|(?:set of |custom fit )?(?:irons|wedges?)|putters?|fairway woods?|stand bag|cart bag|rangefinder|fishing|tackle|carp|angling|rod and reel|e-?bike|e-?scooter|electric scooter|(?:mountain|road|gravel|hybrid) bike|bicycle|cycling|peloton|treadmill|dumbbells?|kettlebells?|home gym|paddle ?board|kayak|wetsuit|tent|camping)\b",
    "home-garden": r"\b(dewalt|makita|milwaukee|sealey|snap-?on|ryobi|einhell|k[aäÄ]rcher|erbauer|halfords advanced|tool ?(?:kit|chest|box|set)|toolbox|topchest|impact (?:driver|wrench)|angle grinder|welder|socket set|cordless drill|workbench|rattan|garden furniture|egg chair|patio|gazebo|pergola|trampoline|lawn ?mower|strimmer|hedge trimmer|leaf blower|pressure washer|jet wash|pizza oven|ooni|gozney|weber|traeger|char-?broil|kamado|smoker\b|log burner|chimenea|fire pit|hot ?tub|lay-?z-?spa|jacuzzi|shed\b|greenhouse|log cabin|summerhouse|(?:corner |garden )?sofa|dining (?:set|table)|mattress|air ?con)\b",
    "tech-giveaways": r"\b(iphone|ipad|macbook|imac|apple ?watch|laptop|notebook|ps5|ps4|playstation|xbox|nintendo|switch\b|console|oled|qled|gpu|rtx|graphics card|gaming pc|airpods|samsung galaxy|galaxy s\d|google pixel|smartphone|tablet|drone|gadget|dyson|vacuum|hoover|air ?fryer|ninja (?:air ?fryer|foodi|blender|kitchen|dual ?zone|double stack|woodfire|creami|slushi|speedi)|shark (?:vacuum|hoover|flexstyle|steam|cordless|stratos)|kitchenaid|nespresso|coffee machine|fridge|freezer|washing machine|dishwasher|microwave|soundbar|speaker|headphones|earbuds|monitor|smartwatch|garmin|fitbit|gopro|projector|robot vacuum|alexa|echo dot|smart home|smart tv|\btv\b)\b",
    "luxury": r"\b(rolex|omega|tudor|breitling|tag ?heuer|cartier|watch|jewellery|jewelry|diamond|designer|holiday|getaway|cruise|spa (?:day|break|weekend)|champagne|prosecco|whisky|whiskey|cognac|perfume|aftershave|fragrance|sunglasses|ray-?ban|handbag|chanel|louis vuitton|gucci|prada|dior|burberry|hermes|mulberry|gold bars?|bullion|krugerrand|sovereign coin)\b",
    "cash-prizes": r"\b(cash|money|jackpot|tax[- ]?free|(?:site|store|account) ?credit|bank transfer|in the bank|gift ?card|voucher|e-?gift|pay ?day|paypal)\b",
}

# An operator's own category labels -> category, tested in this order.
LABEL_RULES = {
    "collectibles": r"\b(warhammer|age of sigmar|sigmar|astra militarum|space marines?|necrons?|tyranids?|horus heresy|kill team|games workshop|citadel|lego|pok[eéÉ]mon|trading cards?|lorcana|magic the gathering|\bmtg\b|yu-?gi-?oh|one piece|funko|tcg|collectibles?|model kits?|airbrush(?:es)?|miniatures?|memorabilia)\b",
    "car-draws": r"\b(cars?|vehicles?|motorbikes?|motorcycles?|automotive)\b",
    "sports-outdoors": r"\b(golf|fishing|angling|bikes?|cycling|e-?bikes?|fitness|gym|sports?|outdoors?|camping)\b",
    "home-garden": r"\b(tools?|diy|garden(?:ing)?|home (?:&|and) garden|furniture|hot ?tubs?|bbqs?|barbecues?)\b",
    "tech-giveaways": r"\b(tech|electronics?|gaming|consoles?|computers?|laptops?|phones?|mobiles?|gadgets?|appliances?|smart home)\b",
    "house-draws": r"\b(house draws?|houses?|propert(?:y|ies)|real estate)\b",
    "luxury": r"\b(luxury|watch(?:es)?|jewell?ery|holidays?|travel|spa days?|designer|bullion)\b",
    "cash-prizes": r"\b(cash|money|instant ?wins?|site credit|vouchers?|gift ?cards?|jackpot)\b",
}

# Texts that excuse a small entry cap.
COLLECTIBLE_TEXT = r"pok[eéÉ]mon|\bpsa\b|\bcard\b|holo|gem ?mint|ace ?10|\btcg\b|graded|\bslab\b|funko|lego|warhammer|age of sigmar|sigmar|astra militarum|space marines?|necrons?|tyranids?|horus heresy|kill team|games workshop|citadel|lorcana|magic the gathering|\bmtg\b|yu-?gi-?oh|model kit"

# Liveness.
NOT_LIVE = ["false", "0", "no", "off"]
FINISHED = r"this competition has (?:now )?finished|competition (?:has )?finished|competition is (?:now )?closed|this draw has (?:now )?(?:ended|closed)"
BLOCKED = r"just a moment|attention required|cf-browser-verification|enable javascript and cookies|verifying you are human|checking your browser|access denied|request blocked"
BLOCKED_HOME = r"just a moment|checking your browser|attention required|cf-browser|access to this (site|service) has been limited|enable javascript and cookies|performing security|verify(ing)? you are human"

# Link patterns.
DRAW_LINK = r"/(product|competition|competitions|draw|draws|raffle|raffles|win|prize|prizes|comp|comps|giveaway|giveaways|ticket|tickets)/[a-z0-9][a-z0-9-]{3,}/?$"
BAD_LINK = r"/(category|categories|collections|product-category|draw-results|winners?|results|past|account|cart|checkout|basket|blog|faq|about|contact|terms|privacy|how-it-works|pages?|my-account|wishlist|login|register)(/|$)"
CATEGORY_TAIL = r"/(cars?|cash|tech|house|houses|luxury|electronics|jewellery|watch(es)?|instant-wins?|all|live|holidays?|gadgets?|home|bundles?)/?$"
BLOB_DRAW_LINK = r"/(competitions?|product|draws?|raffles?|win|prize)/[a-z0-9][a-z0-9-]{4,}/?$"
BLOB_BAD_LINK = r"/(category|categories|instant-wins?|winners?|results|past|account|cart|checkout|basket|faq|about|contact|terms|privacy|how-it-works|watches|cash|tech|cars?)/?$"
OPERATOR_HOST = r"comp(etition)?s?|raffle|draw|giveaway|prize|win"
SITEMAP_PAGE = r"operator|site|review|compan"
DOMAIN_SUFFIX = r"\.(co\.uk|org\.uk|me\.uk|com|co|uk|scot|online|net|io|shop|store|gg|win)$"
SPA_MARK = r"""__NEXT_DATA__|window\.__NUXT__|__remixContext|id="__next"|id="root"|id="app\""""
SPA_TOPIC = r"competition|raffle|draw|prize|ticket"
PAYLOAD_MARK = r'"(?:numTickets|maxTickets|totalTickets|maximumEntries)"\s*:'
ZAP_MARK = r"zapc\s*=\s*\{|product-type-zap_competition|craic-competitions"

# Named HTML entities that are decoded.
ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "pound": "£",
    "euro": "€",
    "hellip": "…",
    "ndash": "–",
    "mdash": "—",
    "rsquo": "’",
    "lsquo": "‘",
    "ldquo": "“",
    "rdquo": "”",
    "trade": "™",
    "reg": "®",
    "copy": "©",
    "amp": "&",
}

# Price text.
PRICE_LABELLED = [
    r"(?:entries?\s+only|tickets?\s+(?:only|from)|per\s+ticket|per\s+entry|priced?\s+from|from)\s*£\s?(\d{1,3}(?:\.\d{1,2})?)(?![\d,])",
    r"£\s?(\d{1,3}(?:\.\d{1,2})?)(?![\d,])\s*(?:per\s+ticket|per\s+entry|each|a\s+ticket|/\s*ticket)",
]
PRICE_BUNDLE_QTY_FIRST = r"(?:\bx|×|\bbuy)\s*(\d{1,4})\s*tickets?\b[^£\d]{0,12}£\s?(\d{1,4}(?:\.\d{1,2})?)\b"
PRICE_BUNDLE_TOTAL_FIRST = r"£\s?(\d{1,4}(?:\.\d{1,2})?)\s*(?:for|=|/)\s*(\d{1,4})\s*tickets?\b"
PRICE_AMOUNT = r"£\s?(\d{1,4}(?:\.\d{1,2})?)(?![\d,])"
PRICE_IS_PRIZE = r"cash|altern|tax[- ]?free|prize|pool|worth|value"

# Entry-cap text: labelled forms, the "only N" form, progress bars, the bare form.
CAP_LABELLED = [
    r"\b(?:max(?:imum)?|total)\s+(?:number\s+)?(?:of\s+)?([\d,]{2,})\s+(?:tickets?|entries?)\b",
    r"\bfrom\s+a\s+maximum\s+(?:number\s+)?of\s+([\d,]{2,})\s+(?:tickets?|entries?)\b",
    r"\b([\d,]{2,})\s+(?:tickets?|entries?)\s+(?:available|in total|in this (?:draw|competition|comp)|on offer|up for grabs|max(?:imum)?)\b",
    r"\b([\d,]{2,})\s+max(?:imum)?\.?\s+(?:tickets?|entries?)\b",
    r"\b(?:tickets?|entries?)\s*(?:available|limited to|capped at|max(?:imum)?)\s*[:\-]?\s*([\d,]{2,})\b",
    r"\bdraw\s+(?:of|limited to)\s+([\d,]{2,})\s+(?:tickets?|entries?)\b",
    r"\b(?:total|max(?:imum)?)\s+(?:number\s+of\s+)?(?:tickets?|entries?)\s*[:\-]\s*([\d,]{2,})\b",
]
CAP_ONLY = r"\b(?:only|just)\s+(?:of\s+)?([\d,]{2,})\s+(?:tickets?|entries?)\b"
CAP_BARS = [
    r"\b([\d,]{2,})\s*/\s*([\d,]{2,})\b",
    r"\b([\d,]{2,})\s+(?:sold\s+)?(?:of|out of)\s+([\d,]{2,})\b",
]
CAP_SOLD_BARS = [
    r"\bsold\s*[:\-]?\s*[\d,]+\s*(?:of|out of)\s*([\d,]{2,})\b",
    r"\bsold\s*[:\-]?\s*[\d,]+\s*/\s*([\d,]{2,})\b",
]
CAP_BARE = r"([£\d,]{3,})\s+(?:tickets?|entries?)\b"
CAP_COUNTER_WORDS = r"\b(sold|remaining|left|used|gone|claimed|to go)\b"
CAP_PER_PERSON = r"\bper\s*(?:person|player|customer|entrant|account|household|entry)\b"
CAP_CONTEXT = 28
CAP_PER_PERSON_CONTEXT = 18
CAP_MIN, CAP_MAX = 100, 10_000_000

# Date text.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DATE_DRAW_LABEL = r"(?:draw(?:n| date| takes? place| will take place| live)?|live\s+draw|drawn live)\D{0,24}(\d{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]+)\s+(\d{4})"
DATE_CLOSE_LABEL = r"\b(?:closes?|closing|ends?)\D{0,24}(\d{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]+)\s+(\d{4})"
DATE_LONG = r"\b(\d{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]{3,})\s+(\d{4})\b"
DATE_ISO = r"\b(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{1,2}):(\d{2}))?"
DATE_NUMERIC = r"\b(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})\b"
TIME_12H = r"(\d{1,2})(?::(\d{2}))?\s*(am|pm)\b"
TIME_24H = r"\b(\d{1,2}):(\d{2})\b"
DEFAULT_TIME = "20:00"
DATE_ATTRIBUTES = ["data-enddate", "data-end-date", "data-draw-date", "data-close-date"]

# Prize text.
PRIZE_HAS_VALUE = r"[£$€]\s?\d|\b\d+\s?(?:k|grand)\b|\b\d[\d,]*\s?(?:cash|tax[- ]?free)\b"
FILLER_WORDS = (
    "daily weekly monthly nightly midweek weekend weekday hourly teatime lunchtime "
    "draw draws drawn raffle raffles competition competitions comp comps giveaway giveaways "
    "prize prizes prized every everytime time times instant instantly win wins winner winners winning "
    "site credit credits madness mystery main event spin spinner wheel mega bumper super special "
    "loyalty free early bird auto automated live today tonight tomorrow now week day "
    "this that the and plus with your our for grabs enter entry entries ticket tickets number"
).split()
PRIZE_BOILERPLATE = r"\b(?:guaranteed\s+draw|draw\s+regardless|auto(?:mated)?\s+draw\s+competition|site\s+credit\s+will|will\s+be\s+applied|if\s+you\s+(?:haven'?t|have\s+not)\s+won|don'?t\s+be\s+disappointed|good\s+luck|we\s+never\s+rollover|terms|t&cs?|please\s+note|how\s+(?:it\s+works|is\s+the\s+winner)|rules?\b|faqs?\b)"
PRIZE_TERMS = r"\b(?:open\s+to\s+(?:uk|gb|all)|residents?\s+aged|aged\s+18|18\s+or\s+over|over\s+18|you\s+can\s+enter|enter\s+(?:this\s+competition\s+)?(?:up\s+to|a\s+(?:maximum|max))|will\s+close|closes?\s+(?:at|on)\b|drawn?\s+(?:live|on|at|via)\b|winner\s+will\s+be|no\s+purchase\s+necessary|free\s+(?:postal\s+)?entry|skill\s+question|per\s+person)\b"
PRIZE_BOAST = r"\b(?:given\s+away|giving\s+away|paid\s+out|in\s+prizes\s+(?:won|paid|given|so\s+far)|prizes\s+won|over\s+£[\d,]+\s+(?:in\s+prizes|paid|won|given)|£[\d,]+\+?\s+in\s+prizes\b|next\s+big\s+winner|become\s+our\s+next)\b"
PRIZE_LABEL = r"^(?:rules?|faqs?|terms?(?:\s*(?:&|and)\s*conditions)?|t&cs?|conditions|description|prize\s+description|details?|delivery|shipping|returns?|how\s+(?:it\s+works|to\s+(?:enter|play))|about(?:\s+us)?|good\s+luck|winners?|main\s+winners?|prizes?|instant\s+wins?|enter\s+now|add\s+to\s+(?:cart|basket)|read\s+more|show\s+more)$"
PRIZE_HEADING = r"^\s*(?:prize\s+description|prize\s+details|what(?:'?s| is| you| could you| do you)[^?]{0,24}win[^?]{0,6}|the\s+prize|main\s+prize|about\s+(?:this|the)\s+prize)\s*[:?]?\s*$"
PRIZE_REVIEW_BOAST = r"given\s+away|in\s+prizes\s+won|over\s+£[\d,]+\s+in\s+prizes|next\s+big\s+winner"

# Page regions.
DATE_SELECTORS = [".draw-date-time", ".draw-date", ".competition-draw-date", ".product-draw-date", "[class*='draw-date']", "[class*='draw_date']"]
CAP_SELECTORS = [".total-tickets", ".tickets-total", ".max-tickets", ".total-entries", "[class*='total-ticket']", "[class*='total-entr']", "[class*='max-ticket']", "[class*='tickets-available']"]
SUMMARY_SELECTORS = [".summary", "[class*='product-summary']", ".single-product", ".product-essential"]
PROGRESS_SELECTORS = ["[class*='lottery-progress']", "[class*='lty-progress']"]
TIMER_SELECTORS = [".lty-lottery-countdown-timer", "[class*='lottery']", "[class*='countdown']"]
FOREIGN_TAGS = ["aside", "nav", "footer", "header"]
FOREIGN_SELECTORS = [".related", ".related-products", ".upsells", ".cross-sells", "[class*='related']", "[class*='upsell']", "[class*='carousel']", "[class*='slider']", "[class*='recommend']", "[class*='you-may']"]

# Content categories: visual weight and the least value worth naming.
CONTENT_CATEGORIES = {
    "car-draws": (1.0, 20000),
    "cash-prizes": (0.4, 5000),
    "house-draws": (0.8, 50000),
    "tech-giveaways": (0.92, 3000),
    "luxury": (1.0, 10000),
    "collectibles": (0.85, 8000),
}
CONTENT_FALLBACK_WEIGHT = 0.6
ARCHETYPES = ["question", "price-anchor", "deadline", "absurd-comparison"]

# Image ranking.
IMAGE_JUNK = r"logo|icons?[-_.]|\bicon\b|sprite|avatar|badge|payment|paypal|visa|mastercard|amex|klarna|clearpay|trustpilot|rating|review-stars|\bflag\b|loader|placeholder|spinner|favicon|cookie|social|whatsapp|tiktok|youtube|app-?store|google-?play|pixel|1x1|blank|spacer|/theme/|/assets/(?:img/)?(?:ui|icons?|theme)|/svg/"
IMAGE_STOP_WORDS = (
    "win this that the a an or and of for with from your you to in on at is are was new tax free cash worth "
    "instant dream draw draws prize prizes giveaway giveaways competition comp comps ticket tickets only just plus get win"
).split()
IMAGE_FILE = r"\.(jpe?g|png|webp)(\?|$)"
IMAGE_HOST = r"cdn/shop|cdn\.shopify|wp-content/uploads|/media/|cloudfront|imgix|cloudinary"
IMAGE_SHARE_HINT = r"og|share|preview|site-?image"
IMAGE_SHARE_URL = r"og-|share|preview|website-image"
IMAGE_ZOOM_HINTS = ["link", "data-large_image", "data-zoom-image"]

# Description frames that give a template away.
TEMPLATE_FRAMES = [
    r"^Win .+ in this UK prize draw\.",
    r"^Fancy winning .+\?.* Enter before the tickets sell out\.$",
    r"^Up for grabs: .+\.",
    r"^Here's your chance to win .+\.",
]
