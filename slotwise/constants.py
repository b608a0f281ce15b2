"""Fixed values the results depend on (they must equal the updater's own)."""

# --- fixed values: partition indexes of an A/B disk -------------------------
INDEX_PART_A = 2          # root slot A
INDEX_PART_B = 6          # root slot B
INDEX_HASH_PART = 7       # verity root-hash partition
INDEX_MAP_PART_A = 4      # verity hash map of slot A
INDEX_MAP_PART_B = 5      # verity hash map of slot B
ALLOWED_ROOT_INDEXES = (INDEX_PART_A, INDEX_PART_B)

# --- fixed values: sizes and timing -----------------------------------------
EXPECTED_RAW_SIZE_MB = 2500   # space needed to unpack a compressed image
WAIT_INTERVAL = 1             # default poll interval of a wait
WAIT_TIMEOUT = 10             # default timeout of a wait

# --- fixed values: names and patterns ---------------------------------------
CRYPTED_PART = "/dev/mapper"
BOOT_IMAGE_A = "linux.efi"
BOOT_IMAGE_B = "linux-2.efi"
VALID_PATH_RE = r"^[a-zA-Z0-9._/-]+$"
VALID_SHA256_RE = r"^[a-fA-F0-9]{64}$"
CONFIG_KEY_RE = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
CONFIG_BAD_VALUE_RE = r"[^a-zA-Z0-9._:/ -]"
IMAGE_ID_PREFIX = "IMAGE_UUID="
LOG_LEVELS = ("ERROR", "WARN", "INFO", "DEBUG")

# --- fixed values: the configuration keys and their defaults, in file order -
CONFIG_DEFAULTS = {
    "IMG_SOURCE": "",
    "IMG_SOURCE_SHA": "",
    "DEBUG": "false",
    "FNRETURN": "",
    "TEMPFILE": "",
    "EXPECTEDRAWSIZE": "2500",
    "LOOPDEV": "",
    "ISDELETESOURCE": "true",
    "INDEXPARTA": "2",
    "INDEXPARTB": "6",
    "INDEXHASHPART": "7",
    "INDEXMAPPARTA": "4",
    "INDEXMAPPARTB": "5",
    "TEMPDATA": "/opt/OS/abupdate",
    "RAWSOURCE": "$TEMPDATA/source.raw",
    "SOURCEBOOTMOUNT": "$TEMPDATA/sourcemount",
    "SOURCECOPY": "$TEMPDATA/sourceos",
    "DESTCOPY": "$TEMPDATA/destos",
    "UPDATEMOUNTPOINT": "$TEMPDATA/abmount",
    "TARGETDEV": "",
    "NEXTBOOT": "",
    "ACTIVEBOOT": "",
    "SOURCEDEV": "",
    "SOURCEBOOTDEV": "",
    "SOURCEEFIMOUNT": "/EFI/Linux/",
    "EFILOCATION": "/boot/efi/EFI/Linux",
    "EFIROOTLOCATION": "/EFI/Linux",
    "BOOTDATA": "/boot/efi/EFI/Linux/update-data",   # staging folder name: a deployment choice
    "CRYPTEDPART": "/dev/mapper",
}

# --- fixed values: error messages in the order the tool emits them, their
# stage, and the exit code of each stage --------------------------------------
STAGE_EXIT_CODE = {"validation": 1, "write": 3, "apply": 3, "commit": 4}
ERROR_STAGE = {
    "No parameters were passed.": "validation",
    "-u requires string input": "validation",
    "-u requires a valid file system path.": "validation",
    "Invalid SHA-256 hash for -s.": "validation",
    "Failed check image sha.": "write",
    "No Suitable Partition for Update Found.": "validation",
    "Failed image extraction.": "write",
    "Failed write image.": "write",
    "Failed copy onboarding var.": "write",
    "Failed write boot.": "write",
    "Failed add login user": "write",
    "Failed relabel selinux.": "write",
    "Failed Set luks UUID.": "write",
    "Failed Set part UUID.": "write",
    "Failed Set Verity.": "write",
    "Nothing to apply.": "validation",
    "Failed apply boot changes.": "apply",
    "Nothing to commit.": "validation",
    "Failed to get active UKI.": "commit",
    "Failed to change boot.": "commit",
    "Failed to commit update OS.": "commit",
    "Path is empty.": "validation",
    "Path does not exist": "validation",
    "Path contains invalid characters.": "validation",
    "Duplicate PARTUUID detected please check image source.": "write",
    "Duplicate luksUUID detected please check image source.": "write",
}
# fixed values: messages that go on with a value
ERROR_PREFIX_STAGE = {
    "Invalid option given: ": "validation",
    "Timeout waiting for ": "write",
}
