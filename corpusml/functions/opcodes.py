"""Default x86 mnemonic vocabulary for assembly listings.

One list for each instruction-set extension of the public architecture
manuals, from the 8086 to SSE3, each complete for its extension; mnemonics
with a condition code are generated.  It is only a default: every tokenizer
takes the vocabulary as a parameter.
"""

from __future__ import annotations

# Condition codes of Jcc, SETcc and CMOVcc, and of FCMOVcc.
CONDITIONS = "o no b nae c ae nb nc e z ne nz be na a nbe s ns p pe np po l nge ge nl le ng g nle".split()
FLOAT_CONDITIONS = "b e be u nb ne nbe nu".split()

# Mnemonics by extension.
I8086 = """
aaa aad aam aas adc add and call cbw clc cld cli cmc cmp cmps cmpsb cmpsw cwd daa das dec div esc hlt idiv imul in
inc int into iret jcxz jmp lahf lds lea les lock lods lodsb lodsw loop loope loopne loopnz loopz mov movs movsb movsw
mul neg nop not or out pop popf push pushf rcl rcr rep repe repne repnz repz ret retf retn rol ror sahf sal sar sbb
scas scasb scasw shl shr stc std sti stos stosb stosw sub test wait xchg xlat xlatb xor
""".split()
I80186 = "bound enter ins insb insw leave outs outsb outsw popa pusha".split()
I80286 = "arpl clts lar lgdt lidt lldt lmsw loadall lsl ltr sgdt sidt sldt smsw str verr verw".split()
I80386 = """
bsf bsr bt btc btr bts cdq cmpsd cwde insd iretd jecxz lfs lgs lodsd lss movsd movsx movzx outsd popad popfd pushad
pushfd scasd shld shrd stosd
""".split()
I80486 = "bswap cmpxchg invd invlpg wbinvd xadd".split()
PENTIUM = "cmpxchg8b cpuid rdmsr rdtsc rsm wrmsr".split()
PENTIUM_PRO = "rdpmc ud2".split()
SYSTEM_CALLS = "syscall sysenter sysexit sysret".split()

X87_LOAD_STORE = "fbld fbstp fild fist fistp fld fst fstp fxch".split()
X87_CONSTANTS = "fld1 fldl2e fldl2t fldlg2 fldln2 fldpi fldz".split()
X87_ARITHMETIC = """
fabs fadd faddp fchs fdiv fdivp fdivr fdivrp fiadd fidiv fidivr fimul fisub fisubr fmul fmulp fprem fprem1 frndint
fscale fsqrt fsub fsubp fsubr fsubrp fxtract
""".split()
X87_COMPARE = "fcom fcomi fcomip fcomp fcompp ficom ficomp ftst fucom fucomi fucomip fucomp fucompp fxam".split()
X87_TRANSCENDENTAL = "f2xm1 fcos fpatan fptan fsin fsincos fyl2x fyl2xp1".split()
X87_CONTROL = """
fclex fdecstp fdisi feni ffree fincstp finit fldcw fldenv fnclex fndisi fneni fninit fnop fnsave fnsetpm fnstcw
fnstenv fnstsw frstor fsave fsetpm fstcw fstenv fstsw fwait
""".split()

MMX = """
emms movd movq packssdw packsswb packuswb paddb paddd paddsb paddsw paddusb paddusw paddw pand pandn pcmpeqb pcmpeqd
pcmpeqw pcmpgtb pcmpgtd pcmpgtw pmaddwd pmulhw pmullw por pslld psllq psllw psrad psraw psrld psrlq psrlw psubb psubd
psubsb psubsw psubusb psubusw psubw punpckhbw punpckhdq punpckhwd punpcklbw punpckldq punpcklwd pxor
""".split()
SSE = """
addps addss andnps andps cmpps cmpss comiss cvtpi2ps cvtps2pi cvtsi2ss cvtss2si cvttps2pi cvttss2si divps divss
fxrstor fxsave ldmxcsr maskmovq maxps maxss minps minss movaps movhlps movhps movlhps movlps movmskps movntps movntq
movss movups mulps mulss orps pavgb pavgw pextrw pinsrw pmaxsw pmaxub pminsw pminub pmovmskb pmulhuw prefetchnta
prefetcht0 prefetcht1 prefetcht2 psadbw pshufw rcpps rcpss rsqrtps rsqrtss sfence shufps sqrtps sqrtss stmxcsr subps
subss ucomiss unpckhps unpcklps xorps
""".split()
SSE2 = """
addpd addsd andnpd andpd clflush cmppd cmpsd comisd cvtdq2pd cvtdq2ps cvtpd2dq cvtpd2pi cvtpd2ps cvtpi2pd cvtps2dq
cvtps2pd cvtsd2si cvtsd2ss cvtsi2sd cvtss2sd cvttpd2dq cvttpd2pi cvttps2dq cvttsd2si divpd divsd lfence maskmovdqu
maxpd maxsd mfence minpd minsd movapd movdq2q movdqa movdqu movhpd movlpd movmskpd movntdq movnti movntpd movq2dq
movsd movupd mulpd mulsd orpd paddq pause pmuludq pshufd pshufhw pshuflw pslldq psrldq psubq punpckhqdq punpcklqdq
shufpd sqrtpd sqrtsd subpd subsd ucomisd unpckhpd unpcklpd xorpd
""".split()
SSE3 = "addsubpd addsubps fisttp haddpd haddps hsubpd hsubps lddqu monitor movddup movshdup movsldup mwait".split()

EXTENSIONS = (
    I8086, I80186, I80286, I80386, I80486, PENTIUM, PENTIUM_PRO, SYSTEM_CALLS, X87_LOAD_STORE, X87_CONSTANTS,
    X87_ARITHMETIC, X87_COMPARE, X87_TRANSCENDENTAL, X87_CONTROL, MMX, SSE, SSE2, SSE3,
)


def default_opcodes() -> tuple[str, ...]:
    """All mnemonics, de-duplicated and sorted."""
    words = {stem + code for stem in ("j", "set", "cmov") for code in CONDITIONS}
    words |= {"fcmov" + code for code in FLOAT_CONDITIONS}
    return tuple(sorted(words.union(*EXTENSIONS)))


DEFAULT_OPCODES = default_opcodes()
