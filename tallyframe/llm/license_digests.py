"""Digests (see ``licenses.digest``) of full license texts in their common forms: with and without title, appendix and
list numbers, and the standard header notices."""

FULL = {
    "0BSD": """
        135f996b0799264a94667b307181b4e708ac75af3dd183e62a37bd0555cbf0cc
        25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c
        3d7b7ce2a6e224f3ce2c959b8b26ed63938ae9ac89a1a93812c66acfe9971516
        53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe
        54643a31416c8580fedbfcb2a7715e66c400a262adcbad165fbe1c9671a3003c
        9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153
    """.split(),
    "Apache-2.0": """
        0b8c1a9e0ec99ab3b27e123e667fe4843df4dd7e6c667ccdc634dd6878c5dd6c
        2e349068b1767ce16c09b3a0a7df25513df42a4881a97a2a0de3ecac55c2ce0a
        4580e5390400d27df89edd0617548ac0e66eaa029f6e07cf98aac9cd100b3a37
        67e6c9864a42fc797b7f0244a9e5402dbe5d51fd1cbfdbca4f454f8892ab077d
        7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7
        84ed161685d232dab5187a7a7101279668d583e8fcead2d41433e4fd4a1dbe68
        d9fe211089c2132237cee118e2f1a7a3eeee0bc0c68216c559e343102c58cd96
        e9653af3ea2451e09943fd25004fb790c5c445256e276a8c0172f0a44c13da0b
    """.split(),
    "Artistic-1.0": """
        e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2
    """.split(),
    "BSD-2-Clause": """
        103c98ea1dcdfdbeeec27381a3e18ee35543712a782539739ec6a31d25bc28bd
        11ec916eac82380be6b3d091aa6a98571180ae1fb0312516878ddc9ebd7bbf32
        22a603ae7ca12ed32433ab981867da4735f74eae59e3da680b1fae36412f6288
        23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2
        2745cc0a63b844cf79449cfeb9dbecb681f38d964a1341225821c2b2e836d0d0
        2c570d136b858b0a4d090e301862eacb53fb1ae2743462bf3b89e602191665f7
        2e9901df2d3cdd9b2ad2d0541a98d0ffe16ec6a54494b7837b493c08b3bde071
        33903615089fdb3ab02696d1bd92eb9580c2c7a0e0c8714aa95b0dfc1dcdb89c
        39a218d326b053017477f11ba35cee9d26fdac59f5656824e14e35aad6ac5ace
        447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2
        7f5d2c72cb2d2d51609adc1fff82fcee645ad3f4500f3330cac3337580115438
        986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74
        a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30
        b02d799e391838a73a0ccc75692ba88eafccab18abbd5f907e855d22048655d4
        b265945940ccdc41492a8c56728fe75bfaf767b67d176e33b2649c7dcf426893
        bc1e385eb5d19c6613b84fb0a516cbaef80caefb192cf62a0c520c07f0fcab07
        cd9b30ab197f107db04da00f4378e43d4fd8ee50988ed680ff3fed81106cb1a8
        d873404919cbc71e0a715d0f2bd267ca90c83465f70b71f472cd8bdf28e56585
        dfb735646da984cb814b2aab18aef097d6e575950073bd82353f618e44014642
        e74f02edf06350e22d771b60d0580c53e28783fd12eda06abd03dab1348bc9d9
        e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9
        f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b
    """.split(),
    "BSD-3-Clause": """
        002ce4b8f1abc08327f935f87bf49584f7fc46fe8139a530cb4ce445fad613c6
        0184c7d3ee3785faae8a8ffc6671060487f079a74e777721db9bdaf6675350c0
        05f67994dd228910e83e6baead31da6bd06e7efb2721c40bbdb72afe22335175
        062a05310a38a72b5194196a22233dcb6ea6732513f4bbd4ea342c44f77c51fd
        0cd54a933ca1a42b76ab8533497e22ea6aabfa37da703814749d4ea7d98e4c49
        17315dbc6c309787bcb7c706980cc71df3a769df14c28c564ebd7dc87cea833d
        19745cb2e838ddc737102a6df737e30cc3bc937060a96168b3e32dda9afaf4d2
        1b167613ca59f5f82731b82383cbf5909d9ad912488377dfa9be2140d94a8a62
        1c26ee0456d1ec83ee27b3b4bac57fe9cf6e417558f2a6afde49b63636bbb26b
        1cd1d5e969d79cbcef71c01797f74adbf640c6c6aaad2bc25b6ebe6feaf1eadf
        1de857b024170679904cc5312e3c0ba9745a155d5302a47b7affb0d2913c9dea
        214aa9c28152d6d77e6bebfb4a7511e677f65fdaf94b0fe9c0bb580e0eaf8997
        21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651
        21faf48f140a987032804b51b63c762a04e1ac3a62939fc1ba17a25c15c164b7
        22b400e3e79aeaf93356bf2b888757a04c98d19c79a9c490b49e1e65728785cf
        27fc5566f50e542addd6ee6d6da5dd182a6d4e5ebc88b6b0967d2e0a98b5c319
        326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903
        36320377bc712df0228f7cd02a978b1639d095cf14c52e5a4eba4e1b3f56ca0c
        36fdcbfc8124635e7071d0ed2271bd9cac0cf975002801d50571c15dd8465554
        3869a7eb34eade633338d788feeb4bab178a8f230053a14abe96d8e1fcee2046
        39362ab8248db1a08a2ce1f9f9ae44445f24893a0eaec24a56bc8a18ee998df4
        3bc6383f474bdef239237d4a1b5040e6458e0fb36c60e336d36cdf40edead279
        3c35df35dbc85b1cd5b6579f56b7b627c0c56af778fb1f5249ed60bade915da9
        3e4593416f0a5c277b02ba7e45d642ddaf5018e5d52305318b77d5249e86cc1f
        427c555094ff2808ab293a29bcf5b83ddcb8cccd0772c83d31ee479d959b120a
        439b47ad2badc685d1f839d73c108dd2fc0f485a8fa1d8f722dc90570de9a0a9
        44d5f2122976da667c376147638bbb5901091365c00f6f5710982f5b3f67d59c
        49d4bc72a1ff6c779c3df162b67c048b3e6e670172f2d9240678059a3ea31474
        4c01287765d4770188bcc961fc5046b414b09fa8b984d16021bbf024247187d1
        4ed0f47db9f788e39de7a60def9f0945109b97a17cb65cea40b135c9911d71ce
        52708ae7496bad323efc341f2b977f4deecc250729644235974381dbffa10b45
        53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa
        53abf9d674e1932fae7438f56165091e8152c2401b99d3c86274bc5ce20deed3
        55f86b555a628a29b6625f8951850429f117f7483c94eb44deef54ea9d5add2b
        56adffc639a3f0760d3416a0f5f890aeaa108f28eec8b40b5edcb7b006242719
        58dfe8fbd266ec105c3ece2cbac98ec487189a5e1e06ca366ec0c5a782527951
        5a4a8574c9001b24cbf954f8ff152e19d697fe266309343060d8badd306361a7
        5a6e7ec0b1ac1e224277a8a6d5cd7691ea38298b0308b87a7a2e539d020ed1e0
        63c7dba1b4db4bb7e78ade9f4a113346ccf778bf36a9e70bb02d03ca99bd93b9
        6410907e3d31b4e9d0a380c3191abc2b101b959edbbe3286b791b636ef1f9176
        6a271d72d919880ed26bb02045e8a4e05a85e0e98e278dbb7caefc4d5bbe8e69
        6a794051fca3bb53638164340f6c2263e652d548fea0d01b009536b223272ba1
        6aee8940ea49459164467e0c55499b7e92ac4571618b9b9e538745b2c40761ff
        6b447d18d19d7da8f98936feff9dc12a238d4fb355080af57e56d70f31155dcb
        6ca53de0eb63ea83a61631ff60836fa90949b50430fb972c63484ef4665ec75a
        6f4beff55f7871e4a13a0ac88a9e7002d2f73ef0f74ac3ac577df1b2656683cb
        6f922c6cb2a22faa1c3d9be59103bf5dc2942321f1c76cc3b6f0772aa184826c
        72d6bb39dd51a58681c09c7b9fa7d1fc0722b5f2467201bb4118a7dc2c57d3aa
        73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da
        80c61e63bc85d93b5268f0cac2469040167159dc420dff1036f946493eae063b
        85a253fdca75357d8f16143d242204d0c291650df54bf470a94c229f0d848c65
        881484f4a940675ce157ad774035e3ee049a5053e14439779f8dd95b14f0ecf7
        89b5580e4d4e4982899a032f08a627f0425471b5cb499f97dd91a218ae52c008
        8d8faff97f22ad3651ea34f409cbd1f45ef349511f9856a97428abc4c499c3cd
        8e9f8e37ac8faa2bfae32ca74748d486612d4cfd038223ef714d11b5025571f1
        8f58342bcad2a20162b5584d1fe21236f58c704ade74498e0536a7aaee33619a
        8f8287391a6868e2ba3836ba40cea3331e97998114968f11c9466efd6911390b
        912a9ee21e203f7f4fadb3c13100e62bfed142edd4b67fa4672c4d62df0ffa5b
        9a555874297cc48b4c505e59638326e6e9341fb0af3c199af45433b2f33717f0
        9ac2a8d687f8f027199caeb75375c6df77a9682afac572cb60e9731941c458f2
        9b38162d6070dc8b0e6d60cac41e1fe3dab7baad6aa97db85a6f60ba3b0c9d40
        9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2
        9dd32148fb3f1c97b8a560b109ab37208ca701688c223199525efb166a389b1b
        a2913b1fe5ecd8bd54076c1871188df65b58a75d04997da2751c54bef98f9976
        a893c2ba323ca9d991baedd41f2edfa59938a11d4ac703d5d2f538f124e176d9
        afc81ee99a150bf9ad976d1b4b3bae3ec8fb30e82c7f9ec18d0048b070d2ebc8
        b376ce28cdcfd6438c10cc05fe7eeaf404fb86eca09e2bae945cda992694b340
        b6093f80a67d752fa17301d7c8f20fe906e6f11169f3a64f9a5816d148eb738f
        b6c6142b7d98b8e270f271557e4fcb03a4aff1b612233af89132f761a4bf42a0
        b771de1d5eb950dadd01f65801529be5d640cbe6c50bf7c93af162c63d3563ca
        bb9673c5222873ae20b44ed8adee0126945a8168f2e943b5cf751ffd142f5f76
        bf48eb9fb708ff3d1e1bc407215dc1fc5bac6220679caeaadefba576bc1ef40b
        c0cc80e9013aae3515c93cc07d3f8ea7593e5f8fb785020bb21f9b21a99672ed
        cb1284543995f6798eab27ff37f3c0383cb8662bd6a290466f39d3d650c6090d
        cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15
        ceb36b0173297578925e297a5e163a7f0f988327f28c8eb9654153d4354b2598
        d007139677ed5a609671515259ab71b9100503be754bfdb34d5560460fa810ab
        d053e6060f6dd5f0710b009813692eeb1bfba03cf929a5f9138f7c3ec0ae6dc5
        d1ecc0a46c23dad7f9e13b19b877e5be7ec9d2b9bb05a2dfde2e47be83438590
        d48abda21efad8d313c79c8cb3efcd99af1c62277c8781868d6f22c9f6d3ae2d
        d5a1629d01b85b2bd2a14b0cad33a9b6092922926adc89a841ae5e8d063ec279
        d75e4e787ecc4324ece56539ff12e2858f0b12ecdda13fefec84195a77b91de7
        d95e4bbb531c9340e58bc26b89c88d79668db642a5c729f6be82393ce4e8507f
        e1c77bcf6c0f4690e88ee18bd465d8d09160c87ff84b4e55a8bcaf74cb1267f7
        e4d34334d1e19820930122c7816c18f12fa68d9d4a2a6d91f53e4567cdb02167
        e612af111b0f62aac3e107973cd804ade8a118ba3c7034d6824ebdce9852ba2e
        e651765ec94c99c2ea03cf19aceb85785d656ba08685eb0772747c296340cb54
        e911b250d03141e6fbfc0564bd0ffaa641b36d0def8ae80127c21add98da2f5d
        ef8ac24af610d366eb6782dc350def12860ed20c0ccb8441d3fd0d3899373ed7
        f078884030f2004a0547e32dde871547116229c227189ee38a4ba782733128ba
        f08c0e129fa396c35826d1a62480eeef35ba2e558d8fb672967aa9d9dd8bc8b2
        f38da92863ee4d4c2433bc6985e35cec8a06261511c68352ec0420ce78b5a889
        f4f0598525c5c35e6dd86dd8cfc49723a4106d91d62d613b0b0ec1c711b5c215
        f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af
        fa865a290dfe6c893d524c854f4fee0b86eab16db9c804ce03044d96482e67e7
        fa95c7b659d1d423e98b6519650c3c7661ff32829677549ec09a88017a2173e3
        fbd420948237995bc7187c5e61a0ddb97bd2e7dfbc6507fedbc97dcb0adce0bd
    """.split(),
    "CC0-1.0": """
        0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3
        2962ebabf2783b8e79876e1dbed7cb6d6e1ade5b084c1ab58461e3609a5cfab6
    """.split(),
    "GFDL-1.2": """
        904a794bbc7744b6d15eb14f31a82f0a63c030a6027c114c32137514dae116f4
        94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60
    """.split(),
    "GFDL-1.3": """
        3eac26c5e7268996bcf1d24538d488924c2ac51bcf0734500dfa91760793fc5d
        a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826
    """.split(),
    "GPL-1.0": """
        018aaaf7231e8a3c8e8a0800c7e593914a330040252f5dc554e1817d1a27f2d4
        5602e195886282e2e70886a9a6562b4421c5d89ade7051bb82f9ded288f1330e
        6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc
        89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70
        8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224
        db97e230402c5d690524aaaae4e5ce0ff7d245046b571e57ebfb91b4e6cd263c
        e8bdee5ef68d911d661ebac90f4d89b6f1484a1a1daf13cec17d578cfd91a2ad
    """.split(),
    "GPL-2.0": """
        00bf89ea716b2e333706c3037f46b8de14a49cc309ee0d760231cc5b6fa65014
        07f9dc67ef43f8488ad21cd89644097f06a71dca46dd84f7c712db10702b0dea
        0c402ad521539a8a21065d20407b18aa34fbc9acb086624ca8f659d557f8fa36
        3543692ec8d596c6ea0bdf28aaff3dac2a8778eb5a7664d6bd1f6717adc294aa
        3606e919f92e4862a5628788f284c07f5a0ca41b819f88414d7e825dca4facc4
        4f48b6749c0afb6df3e9b9baf668fc5e9aad144e3168d3c7714feb616e4ef793
        51d0ce8ce0256ad390999faad46c44fce923aa7ca1a65ad88fa109c100d3cac0
        5587dd013bb7330bf3c7da07b237fbada77a433d8d6b4ad54ab78d2ca1966acf
        58f387b55eb95a9c5a6ef16e9064e1bfa9420a69181c677ee6eddf6ed1397cfd
        61ec0cee6ea2b96e79273be66417c5d7affb7bf7fc9218a751a819ac62050d74
        6583862362f9ec459428ae297d14b1beef0aadd008fd7893a53fc7df5691d392
        69d2200f24e571964ada46a7ea0071004b0dcba4c7bc413d4a857964259d5e74
        6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808
        7528dc9f9df893710fb8dfc1eb2e055937a9cb7ad15a75c3af1e306316322abc
        78e9c9f811bd1ba04ed6d619d3e51a759305d2f124cee9defa3535ba4a24bd25
        7cee9b75cd45caad29f3b9422fa0f7f3e9432c679b4350984b9d407b7f005b83
        7eac18ac7470f052f04563384d13578904e867ba16605f6f1ebcf8a632720b15
        868d7ea4902e2b70c44f8e2163b5ee692389cf1ad18b7ddf128d83f012a9e8cf
        98e760555ff723908d803b23140ebd264fee15e7615bf9486faa0f8f6596c34f
        99072b436b049b565637937025f71dd41fda15902c8230ef160ceb785762b86c
        999b691134c9cbb6c2966307d96ec5edc659b42316572c149cc77731cff2ae09
        a0526787bd7a8c417203fbfa9fe02406e36ff03f29920a78805615fbd5162831
        b1abfb46077acd6c0450274e16fe4cb4610ec546c090c5977a069c5f74340774
        bd48d0e8679cd23be90dea71aebf72a0fc437e9934129ad0c7b57be33a533b0e
        bfca6618ea38de65984d68db07b3047b7994b510ffff2cb850951e069529b8ef
        c026f14006ed4a5e6ab0638f4a50daf3f1e527068c72bac3bcadd9089ac73393
        c87e4f6e0653992bbd6779eebd76969133271c9798ccb5a471dfaf47771cde94
        cde4bac8fb8ed4236f74487f405be684a4febf45f90ae80983ee1ed6bb186fb6
        d872ba76aae56ba5d0d41a15d1137e821faad0bc301c00aa8384b831551e2093
        da190502e4b9bf790474fa9cd9baa2c1f107bd06ad4e0b091544d2d93005c25f
        e0deea08113c1a39c060c5733a436a3333e130ac4aecab400da2e0644b79f525
        e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34
        e986f53bbead119ba63a938a3556545dd76f771775ff34fee9fab01cf3baf051
        e99c1a8366b8178e118afb886451442cc8c488c8f072254d63363e55afe04312
        efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821
    """.split(),
    "GPL-3.0": """
        092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191
        251a280cd3a2b9f25e8b59b375bbe4adc765f8a8556ba180df0ee1873f7969c8
        49178f57692e0ef037a144e5f25202dc317397b55b8338a0ac91133887c36347
        530432c06d7ef9ec3a1b0a3d9920e7e98d423c65be6812c2c0ebd50ad4668878
        575f9b4d2604d65745e0ec0a606c8c17cee519b7b41d71cff0f6bfeae47a2418
        5fbe81957f47e6606efbd16c44b048c92dbca6a44baea2a3efd0ac342f014223
        6d90dd0e551228fefa0f76f203a9f23760c16328e72c94b77606c0ef18f79bf4
        70712b535c4b7c829dce61417479c2c94437bc7c0ef4991f124ba276f8bc8498
        7230dba405e138b5f45ac4e7cd84645bf47d5e74c7ee79baa212156a1a00af5c
        7ce186b0ce006d3467e820ba176cf8a7b91dbb1d46d996cf938877450a33a9bb
        7df310409ea76d4111f8b66c93ae83d9d40a39a8e1983fec59962a2508cabad5
        80d2bf43efa136ac2e7270ccf874f8bcfa290c73ed98846547ea57c88da9dc77
        8f8be072d81bab9c2b6a6c62ff7a97e520ab22820b2afc7200ef47ff6ac95457
        92154f842838abf957a195215402145f210c6df872156cc1242b81289455c74d
        996cf92d00184cd68721746ebfb35b45ae9654557e692f20cbdbe621b85405ce
        9c5928156ea662dfd8de33661b1c9c7280a92c4b9eb1eac5cdddb69a0e8787b1
        a1329a9d725c665a59bdcdb93dc5bddb7b9f3b9c40007c4ae0b647d17ef582c1
        ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636
        ad16f11806c32b8f1b18bd31506ca54675c0d8d3e548a68ef11a7285b69c2ef0
        b1165b3a9c3ac2638585a8adb6e0c10814b7d97627160747134355b2690ff5af
        b217efcead9fa9fdf49d880933d966cb0205221f3a5d5fa913a583496347a841
        beaffd4937a9d79b886333e5b5e16e218d039223ac2edd5cf6d12b643aa4f492
        c3b412736321e1c88faf1cdac030a30307db68e0c12ebbf4af66fde2a239fedf
        c85ce164babf64cf7a4083ac515c643ff954ed557fc4e07fe8e680c2b3d58993
        e144d18f4e4edda40ff04f83347586b05171e0668d68cfd1484654dfadcf55ed
        eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a
        ed2646cd4ecb3a8e54a265e680ec4e80153b49a04276cfa2412c5863f645b118
        eecd2ca90f317f03913cb642203f50c3ebeda143a301455bfd76659b90e91b2b
        fad6d14122ae5943ea05f9e4d48194524a0b701f034fd22c7dded3e6c296c742
        fd4c66a907c7b6f7fecae7eee705e740e20bc16364efaa6a30bb171995b97dbc
        fe83848c114617f4b365d616ef0eb18f790c30c8dee59ec027afba40fc30cf4d
    """.split(),
    "ISC": """
        217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a
        23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1
        280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29
        40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db
        5456fff23cf44064ff54d9d973cf8a7204e2788759d3d01ba3de38afc4515eee
        673f59dc8ad54524704b5b5d2deeb39eec917afad46597b1b7d4f2963edff317
        77e9889024ef4c09ad3e65c9c303459fdde03c84e2f9d24ba9d7cebb938ff23a
        8281b7122b87e54b97a6183786fef9b33350db9bfb9141855ea93e09543e1fcc
        8ee0d4f927294d5cfe44a2a4b1faecb347cc94d0e53edd910b1abc0f6527865f
        929ea44171ff3ef7e5d1c64ee12f9422c4d18c944cd72a089a8c58e61f5f984d
        a285b2987fbd98096b971c73f42998e424fd3014a9690457259734f639dee8eb
        f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee
    """.split(),
    "LGPL-2.0": """
        084782a05c82d5e85c704f06bab601971e84b3b9b90a51c95ffcff2b342d9cf2
        430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2
        504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260
        5478d5a745a3ab1396a1d5db25a9869a5d318700fcf78f26f687effd8e10df4a
        5ce88337a2fce97b0f2b6aac63afc49927c0dc31e15bf530a83e603e1d298d8b
        61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908
        6de169d5260aa3ad51f6555d8351cf6e6cf02bf81e6bcf4a8d2b1a3f648bd7a3
        7b963ffa655dbcc164b6f5a229407c98bdb620d97a461d25ea5f3f30cadf65cf
        7f85bf632315e5d1c4b3f5f8d5eeeb8c4643efd715a16eecb5b2e6b354be750c
        d4689245f0c71022ce729821274153c787fdebe2e92f0de1f6d3c23326a5f619
        dc842683831d008ff5f32600206cfd765e4d05df71fe831b1b4b31462fa2fff1
    """.split(),
    "LGPL-2.1": """
        0aec34034a7eed3ae2e7109c409cfa7189eab52e2aee96013d856daa1ab1ab3f
        22fc5ef04c6f986631929d49e412fef3d1674bb591cce42ce0a3e8dda2b95e6b
        2ef2859ae4577e1d4a14d215abfe8c8b9f6e4ba7dca97a8b81b6c205bf62d7ad
        30f79473a0dcf552322f857e72fab6b3a282d04ee0f693099d14c43f6de2e56a
        344632df3801bf932c289423703cbad1a58a2a58cda2c288e3e12e4f095f1741
        38fd334a43235dc3cc9b4054ff7eda2187759f1748f276e846fe99c0d3225c0f
        39f6abb44bb51f32228c7a133dd927a30d046af0043d1b49381b8e59ea486002
        3c56ca960cd3319a033bfc6ec2b84e3d77c917fe8d0eb19d1bdda642a11235a7
        3eadf799bef5618eda779405ebc7926fe062f9bec74b3a28fff33335331ed399
        48b93c9db1e021fa15b5527b203e72db37d14233ec16435f345724484951f846
        48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4
        49b45e44f75dba3922669540501ab1c85c3d957d6a0808e83a6d47107309ed09
        4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891
        4fe72b9640531c5b22a229785f7d8a85c1e74c51d7d71aeb6a5d15bc02647be9
        54cd0bf6ccd7c9931df9069059dd8053edc06d641c520cd8e8ddccb6423d41b3
        5c6f417ade85844f3ab92c268b3e24c5f9938e40f64f7138632497cb961abeee
        642e1b790fb681945abe50a43d2491408ca39b48daeb5394db08a86dc5d5b12d
        6ada29b92efe1f8ceab4d95b405cd5c3274f946ebfff100583eecc30cfb41a2d
        73ac55304afe4c219acdd0cb7683daf4fe3772c9b493da4a095d93a7789311d5
        7961e9ee1cb6187b3db767ba15af8882ccc83500ed65f60f83b630b1a16ebf6a
        815cf2e3923dc874ab6ea03ec577fd7ac8cbf748e4ab1928ab358e22535a71ce
        889e33cd41ca3ba37d070ecd21cb5bd73c8b6df41313c85f87badf205cf97f38
        91fba5fd5007350e2589cef732142c99ceaac0b15c8e36db486ec21766e5c803
        9cb075bda01847b396eb035deb423c011dddff16c264596c7cb1a8671c0f84be
        a5ac783c64dc7fa3fe7b641692ee7b8da491bd87f613c9bb99618a9469e71c47
        bd06b7347431b0fc243c0e32d1668ab362329b4a591386570abd310334f6fbdb
        bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df
        c2469b247dd63f7768355282bc0c2542e37de1496ae64891d993a36802b4549b
        cea9c814a8eafebce4c9f298e4e502d5e009e6c788cc259e8c6da7420fa7f3f7
        d3630b4c318dc8106243e3c2756522858c7dfa3d359aaf6cef4cc540e3a76204
        d8c2214f424d5a6ca8bc61cef217688005c71f914a38d5d1e2d4e6d6ac4bf9f4
        df8b7d554d9ba4683d95046dc0cd8fdf6c063841a3cfabcf242ab40e69237421
        ef1f927ef7a878df6ca2803df3843c4f46c3b61314caf0d649c6ec0a65199dc0
        fbc12dde87901bc7021f9d27b2ed156e8ba8af3098c2405324afdb1ded7e8a71
        fc5b4ce2c66d62005a1683faea96f75970cd501ab2e5e8a95ca326ae0ebc8089
    """.split(),
    "LGPL-3.0": """
        009f93da4fe9ef462be2e361710b6d0831539fdbf941a097c5daa3bbd0732e3f
        10c07f1e1f9943341169ec8ece67dd0901cbd068e364ada90f5756e46a39286e
        11b87370dc99873c5c39088345097b3111d34e7106bae760e777ee8d306d0bb7
        37ce0af0d65ed71ea44d9b41dff67720b8104ac10968ad4472e75c056f9ccc2a
        3e8bc9c1c259a4a888ebd10e0235faee86b91400cbecd9401a412769b4ba18b7
        449e89cc236ed6772e3a9651de9bd7e1d6698c8368e71a64a35c6cb6be1b2a37
        4c83da3b34c60115d46d4de2b624f5848ced037ff0c02aa0cb0d2496a08e676c
        65013e08ccad81ba8f70d305d95a77368b76c866d11f9eb19ca8f48573960305
        7d8d16c59233829d4089ba34b64c4d1cf36905312e050fc0235ed166e6579f3d
        91eff7750d8c0e171ceeaec56e45a37f504b5a5e3c2e614add0e71797f335c1e
        98771071b7f30cbafcc89807ea9f29855c3cafd61821071c5dbab7d2240c1b69
        9c8b41f383aa3da6f7b5c0e19036ffd781b2662c4e26d3985d8dc4aa5e432287
        a685f1a3c243ad8a4a0c1b5574298028b947136f63ee6ba78afd00c43901da91
        a8cf0a76b6cf61ab5bb639829ea8b87487d08ea277471e7ad879fb6c1dacab38
        a9fa22cf59fefe32de609ae70ee6461003bf8e70b57c44e0c5e6e3baad1cf3c8
        aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be
        c6157c69618f747a5f7bf4af634d1996c8f4f37835f9cd1bbac046caebdcdcfb
        c97da43f21143cfa483d490fbbb846cede84f15b280a371d5f3c376fc15258e3
        d55f73055e58bb45ba8eca26bfe5f3b91426e2cfede6a66456ef0a7b34ed1ae9
        e3b5f4869d977e39bc394716ca25651309aedc5159560a0a761128380e7953a8
        e3dc9d0eea9b416117a0c7ade3a233a2ac70d0c69e6ee5304103131f2142c84b
        e8e0c14b4cc77f112369f77d3ec7c3516adacc9bb45cdba3d2f914fa5920eb7f
        ece0e7c76d260ed58ac64b6414865bb74b9b04bc241560291d7b60e965d025da
        f3a0c0bec724e62ffcb9ac467c02eda2c2ff13423eb14e902e04105050afca1a
        fd016bd3773f602df45790fa64106745e56628140fb1bfd3c66b31cafe51d6c3
    """.split(),
    "MIT": """
        0ae6a1449c55564f09306c58e84bcf7429809a582562aa93352d4acfec8c67cf
        0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c
        35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164
        6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f
        6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127
        7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4
        da895bb880044889333931daa6a944fdf97169e69b254659ae48245146522ee3
        f6977bef8312da49f220a7043e358dc5a0eabeb03043faa779ca620a540879bd
    """.split(),
    "MPL-1.1": """
        1db4ea9e0a781fbc3217db142ddfeb2c60762bea1edf9b713dac4e6d780a0b97
        fb84cdb331a381edd811d3017d5400ac2c74d9d8470038f79413ac78b10c2a59
        fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61
    """.split(),
    "MPL-2.0": """
        25f490dd5976f1aba2273443f5d058a49ed6a13d137c5c252bc8c71221e14b0b
        2cec6f733aa157c2d0b72e9669f75ca354f332218fcb5a3a885931f385272a04
        429c0b9182631e671cffb0adc421caaacb2313655fb2c0aae033db4af1c395aa
        466475ed9edfcfcc55c86b391c3e15278a23f7b9ac7f4fdb14d3b292f7cdcf06
        6d764889ca49f5fae4cb860d8babd1f4af250b5c7e6ad71490a24cc0c5922ed8
        de0e0bad5657ae87b52462bd6dcfbfa29b0e1c9cdb1af2703a8760bce580dd61
        fa31bb5fe4dacb07f1a4ad162be58edb552e9a96a500b68e081943eb2d3cfec5
    """.split(),
    "Unlicense": """
        2678c84ccc8704fa7e91cc97b86954081f3a4a03efb2a16c006bcebbe5aa1b64
        9fbf62f6784505d4a2c57f60a3f6846fdc75ae86d58d163b430639bc7054eb40
        e004e218cb49cc5380ae88b74959546d5ffade35d8fa0f2d1fe2c87f91a33b89
        e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229
        f507d73d343a3d7b0b7ecd39319f6c349b515eeed80b814918af61cdac69e4a5
        fc1f640c3081f07200157ecf84866a527c48cd3f1ae37f29a2631e58e7adbc0a
    """.split(),
}
