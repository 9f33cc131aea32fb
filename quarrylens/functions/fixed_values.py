"""Fixed values that must equal those of the tool whose results are matched: lists, codes and patterns."""

# File names that are not scanned, lower case.
SKIPPED_FILES = (
    "gradlew gradlew.bat mvnw mvnw.cmd gradle-wrapper.jar maven-wrapper.jar thumbs.db babel.config.js license.txt license.md copying.lib makefile"
).split()
# The same for folder hashes.
SKIPPED_FILES_FOLDER_HASH = "gradlew gradlew.bat mvnw mvnw.cmd gradle-wrapper.jar maven-wrapper.jar thumbs.db babel.config.js".split()
# Folders that are not scanned, and an ending of such folders.
SKIPPED_DIRS = "nbproject nbbuild nbdist __pycache__ venv _yardoc eggs wheels htmlcov __pypackages__ example examples".split()
SKIPPED_DIR_ENDINGS = [".egg-info"]
# Endings of files that are not scanned.
SKIPPED_ENDINGS = (
    ".1 .2 .3 .4 .5 .6 .7 .8 .9 .ac .adoc .am .asciidoc .bmp .build .cfg .chm .class .cmake .cnf .conf .config .contributors .copying .crt .csproj .css .csv "
    ".dat .data .doc .docx .dtd .dts .iws .c9 .c9revisions .dtsi .dump .eot .eps .geojson .gdoc .gif .glif .gmo .gradle .guess .hex .htm .html .ico .iml .in "
    ".inc .info .ini .ipynb .jpeg .jpg .json .jsonld .lock .log .m4 .map .markdown .md .md5 .meta .mk .mxml .o .otf .out .pbtxt .pdf .pem .phtml .plist .png "
    ".po .ppt .prefs .properties .pyc .qdoc .result .rgb .rst .scss .sha .sha1 .sha2 .sha256 .sln .spec .sql .sub .svg .svn-base .tab .template .test .tex "
    ".tiff .toml .ttf .txt .utf-8 .vim .wav .woff .woff2 .xht .xhtml .xls .xlsx .xml .xpm .xsd .xul .yaml .yml .wfp .editorconfig .dotcover .pid .lcov .egg "
    ".manifest .cache .coverage .cover .gem .lst .pickle .pdb .gml .pot .plt .whml .pom .smtml .min.js .mf .base64 .s .diff .patch .rules "
    "-doc changelog config copying license authors news licenses notice readme swiftdoc texidoc todo version ignore manifest sqlite sqlite3"
).split()
# Endings of files without snippets.
SNIPPETLESS_ENDINGS = (
    ".exe .zip .tar .tgz .gz .7z .rar .jar .war .ear .class .pyc .o .a .so .obj .dll .lib .out .app .bin .lst .dat .json .htm .html .xml .md .txt .doc .docx "
    ".xls .xlsx .ppt .pptx .odt .ods .odp .pages .key .numbers .pdf .min.js .mf .sum .woff .woff2 .xsd .pom .whl"
).split()
# Limits of winnowing and of snippet eligibility.
GRAM, WINDOW, MIN_SNIPPET_CHARS, MAX_FIRST_LINE = 30, 64, 256, 1000
MAX_POST_BYTES, SNIPPETLESS_POST_BYTES, POST_FILES = 32 * 1024, 8 * 1024, 32
# Scopes of development dependencies.
DEV_SCOPES = "dev test development provided runtime devDependencies dev-dependencies testImplementation testCompile Test require-dev".split()
# Sources of licences, in order of priority.
LICENSE_SOURCES = ["component_declared", "license_file", "file_header", "scancode"]
COPYLEFT_SOURCES = ["component_declared", "license_file"]
# Language of each file suffix.
SUFFIX_LANGUAGE = {
    ".py": "python", ".js": "javascript", ".mjs": "javascript", ".cjs": "javascript", ".ts": "typescript", ".tsx": "typescript", ".jsx": "javascript", ".java": "java",
    ".kt": "kotlin", ".kts": "kotlin", ".scala": "scala", ".sc": "scala", ".go": "go", ".rs": "rust", ".cpp": "cpp", ".cc": "cpp", ".cxx": "cpp", ".c": "cpp", ".h": "cpp",
    ".hpp": "cpp", ".hxx": "cpp", ".cs": "csharp", ".php": "php", ".swift": "swift", ".rb": "ruby", ".pl": "perl", ".pm": "perl", ".r": "r", ".R": "r", ".lua": "lua",
    ".dart": "dart", ".hs": "haskell", ".ex": "elixir", ".exs": "elixir", ".clj": "clojure", ".cljs": "clojure", ".m": "cpp", ".mm": "cpp",
    ".sh": "python", ".bash": "python", ".zsh": "python", ".fish": "python",
}
# Patterns of import lines of each language.
IMPORTS = {
    "python": [r"^\s*import\s+", r"^\s*from\s+.*\s+import\s+"],
    "javascript": [
        r"^\s*import\s+.*\s+from\s+", r"^\s*import\s+[\"']", r"^\s*import\s+type\s+", r"^\s*export\s+\*\s+from\s+", r"^\s*export\s+\{.*\}\s+from\s+",
        r"^\s*const\s+.*\s*=\s*require\(", r"^\s*var\s+.*\s*=\s*require\(", r"^\s*let\s+.*\s*=\s*require\(",
    ],
    "typescript": [r"^\s*import\s+", r"^\s*export\s+.*\s+from\s+", r"^\s*import\s+type\s+", r"^\s*import\s+\{.*\}\s+from\s+"],
    "java": [r"^\s*import\s+", r"^\s*package\s+"],
    "kotlin": [r"^\s*import\s+", r"^\s*package\s+"],
    "scala": [r"^\s*import\s+", r"^\s*package\s+"],
    "go": [r"^\s*import\s+\(", r"^\s*import\s+\"", r"^\s*package\s+", r"^\s*\"[^\"]*\"\s*$", r"^\s*[a-zA-Z_][a-zA-Z0-9_]*\s+\"[^\"]*\"\s*$", r"^\s*_\s+\"[^\"]*\"\s*$"],
    "rust": [r"^\s*use\s+", r"^\s*extern\s+crate\s+", r"^\s*mod\s+"],
    "cpp": [r"^\s*#include\s+", r"^\s*#pragma\s+", r"^\s*#ifndef\s+.*_H.*", r"^\s*#define\s+.*_H.*", r"^\s*#endif\s+(//.*)?\s*$"],
    "csharp": [r"^\s*using\s+", r"^\s*namespace\s+"],
    "php": [r"^\s*use\s+", r"^\s*require\s+", r"^\s*require_once\s+", r"^\s*include\s+", r"^\s*include_once\s+", r"^\s*namespace\s+"],
    "swift": [r"^\s*import\s+"],
    "ruby": [r"^\s*require\s+", r"^\s*require_relative\s+", r"^\s*load\s+"],
    "perl": [r"^\s*use\s+", r"^\s*require\s+"],
    "r": [r"^\s*library\(", r"^\s*require\(", r"^\s*source\("],
    "lua": [r"^\s*require\s+", r"^\s*local\s+.*\s*=\s*require\("],
    "dart": [r"^\s*import\s+", r"^\s*export\s+", r"^\s*part\s+"],
    "haskell": [r"^\s*import\s+", r"^\s*module\s+"],
    "elixir": [r"^\s*import\s+", r"^\s*alias\s+", r"^\s*require\s+", r"^\s*use\s+"],
    "clojure": [r"^\s*\(\s*ns\s+", r"^\s*\(\s*require\s+", r"^\s*\(\s*import\s+"],
}
# Copyleft status of licences, as the public checklists of licence obligations (CC-BY-4.0) give it.
COPYLEFT_YES = "AGPL-3.0-only AGPL-3.0-or-later CPL-1.0 EPL-1.0 EUPL-1.1 EUPL-1.2 GPL-1.0-only GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later IPL-1.0 OSL-3.0 Sleepycat".split()
COPYLEFT_RESTRICTED = [
    "APSL-2.0", "CDDL-1.0", "CDDL-1.1", "EPL-2.0", "GPL-2.0-only WITH Classpath-exception-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-1.1", "MPL-2.0", "MPL-2.0-no-copyleft-exception", "MS-RL", "OFL-1.1", "Ubuntu-font-1.0",
]
COPYLEFT_QUESTIONABLE = "MS-PL OpenSSL".split()
COPYLEFT_NO = (
    "0BSD AFL-2.0 AFL-2.1 AFL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 Bitstream-Vera blessing BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause "
    "BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Open-MPI BSD-4-Clause BSD-4-Clause-UC BSD-4.3TAHOE BSD-Source-Code BSL-1.0 bzip2-1.0.5 bzip2-1.0.6 CC-BY-2.5 CC-BY-3.0 curl ECL-1.0 "
    "ECL-2.0 EFL-2.0 FSFAP FSFUL FSFULLR FSFULLRWD FTL HPND IBM-pibs ICU IJG ImageMagick Info-ZIP ISC JasPer-2.0 Libpng libpng-2.0 libtiff LicenseRef-scancode-bsla-no-advert "
    "LicenseRef-scancode-info-zip-2003-05 LicenseRef-scancode-ppp Minpack MirOS MIT MIT-0 MIT-CMU NBPL-1.0 NCSA NTP OGC-1.0 OLDAP-2.8 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 Qhull RSA-MD "
    "Saxpath SGI-B-2.0 SMLNJ Spencer-86 SSH-OpenSSH SSH-short SunPro Unicode-3.0 Unicode-DFS-2015 Unicode-DFS-2016 Unlicense UPL-1.0 W3C W3C-19980720 W3C-20150513 WTFPL X11 XFree86-1.1 "
    "Zlib zlib-acknowledgement ZPL-2.0"
).split()
# Components of a CSV report, in order.
CSV_COLUMNS = (
    "inventory_id path detected_usage detected_component detected_license detected_version detected_latest detected_purls detected_url detected_match detected_lines detected_oss_lines detected_path"
).split()
