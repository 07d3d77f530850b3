"""Words, patterns, labels and lookup tables that results depend on."""

# Tag patterns, matched on lower-cased text.
BENEFIT_PATTERNS = {
    "13th_month": r"(13th\s*month|tháng\s*13)",
    "healthcare_insurance": r"(health\s*care|health\s*insurance|bảo\s*hiểm|bao\s*hiem|medical)",
    "bonus_performance": r"(performance\s*bonus|thưởng|thuong|incentive)",
    "hybrid_remote": r"(hybrid|remote|work\s*from\s*home|wfh|flexible)",
    "laptop_macbook": r"(macbook|laptop|device)",
    "annual_leave": r"(annual\s*leave|paid\s*leave|phép\s*năm|nghỉ\s*phép)",
    "team_building": r"(team\s*building|company\s*trip|outing)",
    "training_certificate": r"(training|certificate|sponsorship|đào\s*tạo)",
}

SOFT_SKILL_PATTERNS = {
    "communication": r"(communication|giao\s*tiếp)",
    "teamwork": r"(teamwork|team\s*work|làm\s*việc\s*nhóm)",
    "problem_solving": r"(problem\s*solving|giải\s*quyết\s*vấn\s*đề)",
    "english": r"(english|tiếng\s*anh)",
    "japanese": r"(japanese|tiếng\s*nhật)",
}

# Role of a job title: the first rule with a matching keyword wins.
ROLE_RULES = [
    (["data", "ai", "machine learning", "nlp", "deep learning"], "Data & AI"),
    (["backend", "front end", "frontend", "web", "full stack", "fullstack", "php", "node",
      "react"], "Web Development"),
    (["mobile", "ios", "android", "flutter", "react native"], "Mobile Development"),
    (["devops", "sysadmin", "system", "cloud", "aws", "azure", "infrastructure", "security",
      "network"], "System & DevOps"),
    (["tester", "qa", "qc", "test"], "QA & Testing"),
]

# Place names (LIKE patterns) and their codes.
CITY_RULES = [
    (["%Hồ Chí Minh%"], "HCM"),
    (["%Hà Nội%"], "HN"),
    (["%Đà Nẵng%"], "DN"),
]

# City code by lower-case name, in lookup order.
CITY_CODES = {
    "hà nội": "HN",
    "ha noi": "HN",
    "hn": "HN",
    "hồ chí minh": "HCM",
    "ho chi minh": "HCM",
    "hcm": "HCM",
    "đà nẵng": "DN",
    "da nang": "DN",
    "dn": "DN",
}

LEVELS = ["Fresher", "Junior", "Senior", "Manager"]

# Level of a posting: the first level with a matching keyword wins.
LEVEL_RULES = [
    (["fresher", "mới ra trường", "graduate", "entry", "entry-level"], "Fresher"),
    (["junior", "junior developer", "junior engineer"], "Junior"),
    (["middle", "mid-level", "senior developer", "medium"], "Middle"),
    (["senior", "senior developer", "senior engineer", "lead", "principal"], "Senior"),
    (["architect", "solutions architect", "lead architect"], "Architect"),
]

SALARY_EDGES = [15e6, 30e6, 50e6, 80e6]
SALARY_LABELS = ["1. < 15 Triệu", "2. 15-30 Triệu", "3. 30-50 Triệu", "4. 50-80 Triệu",
                 "5. > 80 Triệu"]

YEAR_EDGES = [1, 2, 4, 6, 9]
YEAR_LABELS = ["00-01yr (Fresher)", "02yr    (Junior)", "03-04yr (Mid-level)",
               "05-06yr (Senior)", "07-09yr (Lead)", "10+yr   (Expert/Mgr)"]

KNOWN_SKILLS = [
    "python", "java", "c#", "c++", "javascript", "typescript",
    "react", "angular", "vue", "nodejs", "nestjs",
    "docker", "kubernetes", "aws", "azure", "gcp",
    "sql", "mysql", "postgresql", "mongodb", "redis",
    "kafka", "spark", "airflow", "tensorflow", "pytorch",
    "fastapi", "flask", "django", "git", "linux", "ai",
    "machine learning", "deep learning", "nlp", "llm",
    "langchain", "llamaindex", "computer vision",
    "oracle", "elasticsearch", "nginx", "spring",
    "golang", "rust", "php", "ruby", "swift", "kotlin",
    "hadoop", "hive", "tableau", "powerbi", "excel",
    "figma", "photoshop", "jira", "agile", "scrum",
    "selenium", "jenkins", "terraform", "ansible",
]

VIETNAMESE_STOP_WORDS = [
    "và", "các", "có", "của", "để", "với", "trong", "là", "được", "cho",
    "tại", "theo", "về", "từ", "bạn", "chúng", "tôi", "họ", "này", "đó",
    "khi", "nếu", "thì", "mà", "hay", "hoặc", "cũng", "đã", "sẽ", "đang",
    "rất", "nhiều", "một", "những", "không", "như", "sau", "trên", "dưới",
    "giữa", "ngoài", "trước", "qua", "lên", "xuống", "cùng",
]

# Phrases that stand for an amount, and the label they get.
SALARY_PHRASES = [
    (["sign in to view salary", "login to view salary", "salary hidden"], "Hidden"),
    (["negotiable", "thương lượng", "thoả thuận", "thỏa thuận"], "Negotiable"),
    (["competitive"], "Competitive"),
    (["attractive"], "Attractive"),
]

# Short blocks of a page that show the pay: words of blocks that do not, the phrase for an open
# amount with the text it gives, and marks of amounts without a number.
PAY_BLOCK_NOISE = [
    "tuyển", "ứng tuyển", "mô tả công việc", "yêu cầu công việc", "thông tin việc làm",
    "địa điểm làm việc", "việc làm cùng công ty", "tại ", "để xem nhiều việc làm", "intern",
    "fresher", "dưới 3 năm kinh nghiệm", "tải upzi",
]
PAY_BLOCK_OPEN = ("thương lượng", "Thương lượng")
PAY_BLOCK_MARKS = ["triệu", "usd", "vnd", "/tháng", "/month"]

# City names as pages write them, and their codes, in lookup order.
CITY_NAMES = [(["Hồ Chí Minh"], "HCM"), (["Hà Nội"], "HN"), (["Đà Nẵng"], "DN")]

SALARY_UNITS = "usd|vnd|vnđ|triệu|million"

# Words that mark a street address rather than a city.
ADDRESS_WORDS = "số|tòa|phường|ward|street|đường|floor|khu|building"

DESCRIPTION_STARTS = [
    "Job Description", "Job Responsibilities", "Responsibilities", "Requirements",
    "Mô tả công việc", "Yêu cầu công việc", "Quyền lợi", "The Job",
]
DESCRIPTION_STOPS = [
    "Thông tin cá nhân", "Nguồn Tuyển dụng", "Vì sao Bạn nên đảm bảo đầy đủ thông tin",
    "Hồ sơ của Bạn sẽ được đánh giá", "Chủ động liên hệ phỏng vấn",
    "Ứng viên vui lòng kiểm tra email", "Cập nhật ngay thông tin mới nhất", "FanPage",
    "Ai yêu Miền Bắc", "Ai yêu Miền Trung", "Ai yêu Miền Nam",
]
DESCRIPTION_ENDS = [
    "Best IT Companies", "Reviews include", "FanPage", "Ai yêu Miền",
    "This website uses a security service", "Cập nhật ngay",
]
DESCRIPTION_NOISE = [
    "fanpage", "best it companies", "reviews include", "sign in to view salary",
    "cập nhật ngay", "ai yêu miền", "ứng viên", "hồ sơ", "thông tin cá nhân", "số điện thoại",
    "email", "nguồn tuyển dụng", "ứng tuyển", "liên hệ", "kiểm tra email", "phỏng vấn",
]

SKILL_NOISE = ["apply", "login", "jobs"]
TAG_NOISE = ["việc làm", "đăng nhập", "ứng tuyển", "trang chủ", "tìm kiếm", "upzi",
             "lưu công việc", "thương lượng", "lượt xem"]
COMPANY_NOISE = ["lưu công việc", "tải upzi", "xem thêm", "việc làm", "dành cho nhà tuyển dụng",
                 "tất cả danh mục", "việc làm theo khu vực", "việc làm theo ngành nghề"]

DEAD_PAGE_TEXT = "oops! the job you're looking for doesn't exist"

# Where pages keep a machine-readable amount: element id, attribute, JSON field; and the classes
# of the element that shows it.
SALARY_NODE_ID = "jd-main"
SALARY_NODE_ATTRIBUTE = "data-jobs-save-data-layer-value"
SALARY_NODE_FIELD = "salary_range"
SALARY_BOX_CLASSES = ["salary", "text-success-color"]

# Elements that name the employer, by part of their class, and the path of employer links.
COMPANY_CLASSES = ["company-name", "employer-name"]
COMPANY_LINK = "/nha-tuyen-dung/"

# Attributes that may hold a link to a posting.
LINK_ATTRIBUTES = ["href", "data-job-url", "data-href", "data-url", "data-link", "data-target"]

# Amounts in the local currency per unit.
EXPERIENCE_RANGE = r"(\d+)\s*-\s*(\d+)\s*(?:năm|year|yrs?)"
EXPERIENCE_YEARS = r"(?:ít nhất|at least|minimum)?\s*(\d+)\s*(?:năm|year|yrs?)"
NO_PAY_TEXT = "Y-u'll l-ve i-USD"
SALARY_RATES = {"usd": 25_400.0, "million": 1e6, "triệu": 1e6, "vnđ": 1.0, "vnd": 1.0}
