"""Word lists used by the text operators.

Every list is a plain argument of its operator; these are the defaults. They are
fixed values: results agree only when the lists do, and where order is
significant (ties, first match) it is kept.
"""

# Catalogue categories, one point per keyword, earlier entry wins ties.
CATEGORY_KEYWORDS: dict[str, list[str]] = {
    "Electronics": ["laptop", "computer", "phone", "tablet", "monitor", "keyboard", "mouse",
                    "processor", "gpu", "ram", "ssd", "hdmi", "usb"],
    "Audio": ["headphone", "earphone", "speaker", "earbuds", "bluetooth audio", "microphone",
              "amplifier", "soundbar", "subwoofer"],
    "Camera": ["camera", "lens", "tripod", "dslr", "mirrorless", "gopro", "memory card",
               "filter", "flash"],
    "Gaming": ["gaming", "game", "console", "playstation", "xbox", "nintendo", "controller",
               "joystick", "gpu", "graphics card"],
    "Smart Home": ["smart", "alexa", "google home", "ring", "nest", "iot", "automation",
                   "sensor", "hub"],
    "Wearables": ["watch", "smartwatch", "fitness tracker", "band", "garmin", "fitbit",
                  "apple watch", "samsung watch"],
    "Kitchen": ["kitchen", "cooking", "blender", "mixer", "microwave", "oven", "coffee",
                "kettle", "air fryer", "toaster"],
    "Fashion": ["shirt", "dress", "pants", "shoes", "jacket", "bag", "wallet", "sunglasses",
                "hat", "clothing"],
    "Books": ["book", "novel", "textbook", "guide", "manual", "paperback", "hardcover", "ebook",
              "reader"],
    "Sports": ["sport", "fitness", "gym", "yoga", "running", "cycling", "swimming", "tennis",
               "football", "basketball"],
    "Beauty": ["beauty", "skincare", "makeup", "lipstick", "foundation", "serum", "moisturizer",
               "shampoo", "perfume"],
    "Toys": ["toy", "lego", "puzzle", "doll", "action figure", "board game", "kids", "children",
             "play"],
    "Automotive": ["car", "vehicle", "auto", "tire", "brake", "motor", "engine", "dashboard",
                   "seat cover"],
    "Office": ["office", "desk", "chair", "printer", "scanner", "paper", "pen", "notebook",
               "stapler"],
    "Drones": ["drone", "quadcopter", "fpv", "dji", "aerial", "uav", "propeller",
               "remote control"],
}

# Recommender categories, scored 2 for keywords over 4 letters, else 1.
RECOMMENDER_KEYWORDS: dict[str, list[str]] = {
    "Electronics": ["laptop", "computer", "desktop", "processor", "ram", "ssd", "monitor",
                    "keyboard", "mouse", "charger", "cable", "usb", "hdmi", "battery", "phone",
                    "tablet", "ipad"],
    "Audio": ["headphone", "earphone", "speaker", "earbud", "bluetooth", "microphone",
              "soundbar", "audio", "bass", "stereo", "amp"],
    "Camera": ["camera", "lens", "tripod", "dslr", "mirrorless", "gopro", "photo", "video",
               "flash", "filter", "memory card"],
    "Gaming": ["gaming", "game", "console", "playstation", "xbox", "nintendo", "controller",
               "joystick", "fps", "gpu"],
    "Smart Home": ["smart", "alexa", "google home", "security camera", "ring", "nest",
                   "thermostat", "doorbell", "sensor", "automation"],
    "Wearables": ["watch", "smartwatch", "fitness tracker", "band", "garmin", "fitbit",
                  "apple watch", "heart rate"],
    "Kitchen": ["kitchen", "cooking", "blender", "mixer", "microwave", "oven", "coffee",
                "kettle", "air fryer", "toaster", "pot"],
    "Fashion": ["shirt", "dress", "pants", "shoes", "jacket", "bag", "wallet", "hat",
                "clothing", "apparel", "wear"],
    "Books": ["book", "novel", "textbook", "guide", "paperback", "hardcover", "ebook",
              "reading", "literature"],
    "Sports": ["sport", "fitness", "gym", "yoga", "running", "cycling", "swimming", "tennis",
               "football", "basketball", "workout"],
    "Beauty": ["beauty", "skincare", "makeup", "lipstick", "foundation", "serum",
               "moisturizer", "shampoo", "perfume", "cosmetic"],
    "Toys": ["toy", "lego", "puzzle", "doll", "action figure", "board game", "kids",
             "children", "play", "educational"],
    "Automotive": ["car", "truck", "vehicle", "auto", "tire", "brake", "motor", "engine",
                   "dashboard", "polaris", "rzr", "utv", "motorcycle", "trailer", "towing",
                   "ramp"],
    "Office": ["office", "desk", "chair", "printer", "scanner", "paper", "pen", "notebook",
               "stapler", "filing"],
    "Tools": ["tool", "drill", "wrench", "screwdriver", "hammer", "saw", "plier", "socket",
              "epoxy", "sealant", "adhesive"],
    "Home": ["home", "furniture", "bedding", "curtain", "lamp", "rug", "storage", "organizer",
             "frame", "decor"],
}

# Brands in match order.
BRANDS: list[str] = [
    "apple", "samsung", "sony", "lg", "microsoft", "google", "amazon", "dell", "hp", "lenovo",
    "asus", "acer", "nvidia", "intel", "amd", "bose", "jbl", "beats", "sennheiser", "logitech",
    "razer", "corsair", "anker", "belkin", "tp-link", "netgear", "wd", "seagate", "sandisk",
    "nikon", "canon", "gopro", "dji", "garmin", "fitbit", "xiaomi", "oneplus", "realme", "oppo",
    "vivo", "motorola", "nokia", "huawei", "philips", "panasonic", "sharp", "toshiba",
    "hitachi", "bosch", "adidas", "nike", "puma", "under armour", "reebok",
]

# Feature names with their keywords, in output order.
FEATURE_KEYWORDS: dict[str, list[str]] = {
    "battery": ["battery", "mah", "charging", "charge", "power"],
    "display": ["screen", "display", "resolution", "4k", "hd", "oled", "lcd", "amoled"],
    "camera": ["camera", "megapixel", "mp", "lens", "photo", "video"],
    "performance": ["processor", "cpu", "gpu", "ram", "storage", "speed", "fast"],
    "connectivity": ["wifi", "bluetooth", "5g", "4g", "nfc", "usb", "hdmi"],
    "design": ["slim", "lightweight", "portable", "compact", "waterproof"],
}

# Aspect names with their keywords, in output order.
ASPECT_KEYWORDS: dict[str, list[str]] = {
    "battery": ["battery", "charge", "charging", "power", "mah", "last"],
    "camera": ["camera", "photo", "picture", "image", "lens", "shoot"],
    "display": ["screen", "display", "bright", "resolution", "color"],
    "performance": ["fast", "speed", "slow", "lag", "smooth", "performance"],
    "price": ["price", "cost", "value", "cheap", "expensive", "worth"],
    "build": ["build", "quality", "material", "durable", "plastic", "metal"],
    "delivery": ["delivery", "shipping", "arrived", "package", "box"],
}

# Polarity words of the aspect step.
POSITIVE_WORDS = ["good", "great", "excellent", "amazing", "best", "love", "perfect",
                  "fantastic", "awesome", "superb", "brilliant"]
NEGATIVE_WORDS = ["bad", "poor", "terrible", "worst", "hate", "broken", "defective",
                  "disappointed", "waste", "awful", "horrible"]

# Seed lexicon for sentiment: the polarity words above with valences on the -4..4
# scale of rule-based sentiment scoring. Supply a full lexicon table for real use.
SEED_LEXICON: dict[str, float] = {
    "good": 1.9, "great": 3.1, "excellent": 2.7, "amazing": 2.8, "best": 3.2, "love": 3.2,
    "perfect": 2.7, "fantastic": 2.6, "awesome": 3.1, "superb": 3.1, "brilliant": 2.8,
    "nice": 1.8, "bad": -2.5, "poor": -2.1, "terrible": -2.1, "worst": -3.1, "hate": -2.7,
    "broken": -2.1, "defective": -1.9, "disappointed": -1.9, "waste": -1.8, "awful": -2.0,
    "horrible": -2.5,
}

# Fixed values of the published rule-based method: negations and degree words as they
# read after cleaning (apostrophes have become blanks).
NEGATIONS = ["not", "never", "no", "none", "nobody", "nothing", "neither", "nor", "nowhere",
             "without", "cannot", "cant", "dont", "wont", "isnt", "wasnt", "hardly", "don",
             "isn", "wasn", "didn", "doesn"]
INTENSIFIERS = ["very", "really", "extremely", "absolutely", "completely", "incredibly",
                "totally", "so", "highly", "especially"]
DAMPENERS = ["barely", "slightly", "somewhat", "almost", "partly", "marginally", "kinda"]

# Words that carry no product detail, one list per fake-score preset.
GENERIC_BATCH = ["great", "good", "nice", "perfect", "love", "best", "excellent"]
GENERIC_API = ["great", "good", "nice", "perfect", "love", "best", "excellent", "amazing",
               "awesome"]
GENERIC_RAW = ["amazing", "best", "great", "perfect", "love", "excellent", "awesome"]

# Function words dropped before TF-IDF; a default of our own, pass another list to change it.
STOP_WORDS = [
    "about", "above", "after", "again", "all", "am", "an", "and", "any", "are", "as", "at", "be",
    "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "did",
    "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had",
    "has", "have", "having", "he", "her", "here", "him", "his", "how", "if", "in", "into", "is",
    "it", "its", "just", "me", "more", "most", "my", "no", "nor", "not", "now", "of", "off",
    "on", "once", "only", "or", "other", "our", "out", "over", "own", "same", "she", "so",
    "some", "such", "than", "that", "the", "their", "them", "then", "there", "these", "they",
    "this", "those", "through", "to", "too", "under", "until", "up", "very", "was", "we", "were",
    "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with", "you",
    "your",
]
